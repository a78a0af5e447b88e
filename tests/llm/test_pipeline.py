"""The stages one after another on documents whose fate is known."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from runtrace.llm import pieces, secrets
from runtrace.sources.staging import BATCH_BYTES


def _corpus(spark, folder):
    dice = random.Random(9)
    pool = ["".join(dice.choice(["ka", "lu", "tor", "mim", "ash"]) for _ in range(3)) for _ in range(400)]
    some = lambda n: " ".join(dice.choice(pool) for _ in range(n))
    rows = [(i, some(dice.randrange(20, 80)), "xa", "s", 0) for i in range(120)]
    item = some(30)
    rows += [(200, rows[0][1], "xa", "s", 0), (201, "12 34", "xa", "s", 0), (202, None, None, None, None), (203, some(40) + " " + item, "xa", "s", 0),
             (204, some(30) + " password=abcdefgh12345678", "xa", "s", 0), (205, rows[1][1].upper() + " " + pool[0], "xa", "s", 0), rows[3], rows[3]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_documents_that_stay(spark, tmp_path):
    rows = _corpus(spark, f"{tmp_path}/in")
    texts = dict(r[:2] for r in rows)
    docs = spark.read.parquet(f"{tmp_path}/in/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        schema = docs.schema
        stage(spark, docs, f"{tmp_path}/in").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.schema == schema
    kept = {r.doc_id: r for r in docs.collect()}
    assert set(kept) == set(range(120)) | {204} and docs.count() == 121
    assert kept[204].text.endswith(" [assign]") and kept[204].n_chars == len(kept[204].text)
    assert all(kept[i].text == texts[i] for i in range(120))
    words = pieces.load()
    done = corpus_pipeline.run(spark, f"{tmp_path}/in").collect()
    assert {r.doc_id for r in done} == set(kept) and len(done) == 121
    assert all(r.round_trip and pieces.decode(r.ids, words).decode() == kept[r.doc_id].text for r in done)


def test_empty_documents(spark, tmp_path):
    _corpus(spark, f"{tmp_path}/full")
    spark.read.parquet(f"{tmp_path}/full/documents.parquet").limit(0).write.parquet(f"{tmp_path}/in/documents.parquet")
    spark.read.parquet(f"{tmp_path}/full/benchmark.parquet").write.parquet(f"{tmp_path}/in/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/in").count() == 0


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    """A session without a batch size of its own, also afterwards."""
    spark.conf.unset(_BATCH)
    yield spark
    spark.conf.unset(_BATCH)


def _batch_bytes(docs):
    """Bytes of the texts in each Arrow batch that goes to Python."""
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches)
    return docs.select("text").mapInArrow(sizes, "n bigint")


@pytest.mark.parametrize("stage", [corpus_pipeline.redacted, corpus_pipeline.encoded])
def test_rows_of_a_stage_go_to_python_in_small_batches(unset, stage):
    docs = unset.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ka lu tor mim "), 300).alias("text")).coalesce(1)
    stage(unset, docs.limit(3), "")
    got = [r.n for r in _batch_bytes(docs).collect()]
    assert sum(got) > 5 * BATCH_BYTES and max(got) < 2 * BATCH_BYTES


def test_the_whole_pipeline_leaves_the_session_as_it_was(unset, tmp_path, monkeypatch):
    _corpus(unset, f"{tmp_path}/in")
    before, seen = unset.conf.get(_BATCH), []
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("look", lambda spark, docs, _: seen.append(spark.conf.get(_BATCH)) or docs)])
    corpus_pipeline.run(unset, f"{tmp_path}/in")
    assert seen == [str(BATCH_BYTES)] and unset.conf.get(_BATCH) == before != str(BATCH_BYTES)


def test_slices_of_secrets_and_pieces_are_bounded():
    assert pieces._SLICE <= 1 << 20 and secrets._BYTES <= 1 << 18
