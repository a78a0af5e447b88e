"""Components against all pairs in plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runtrace.llm import jaccard_join as op
from runtrace.llm.textbytes import slices
from runtrace.sources.staging import BATCH_BYTES, small_batches, stage


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def _expected(docs):
    sets = [_set(t) for _, t in docs]
    label, links = list(range(len(docs))), [0] * len(docs)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and 100 * both >= 80 * (len(x) + len(sets[j]) - both):
                label[root(i)] = root(j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(doc, len(s), least.get(root(i)) if s else doc, links[i]) for i, ((doc, _), s) in enumerate(zip(docs, sets))]


def _corpus(seed):
    dice = random.Random(seed)
    pool = [f"w{i}" for i in range(300)]
    passage = [dice.choice(pool) for _ in range(60)]
    docs = []
    for _ in range(12):
        base = [dice.choice(pool) for _ in range(dice.randrange(3, 90))]
        for _ in range(dice.randrange(1, 14)):
            words = list(base)
            for _ in range(dice.randrange(0, 5)):
                words[dice.randrange(len(words))] = dice.choice(pool)
            if dice.random() < 0.2:
                words += passage[: dice.randrange(10, 60)]
            docs.append(" ".join(words))
    docs += ["A b C", "a B c", "a b c d e", "a b c d", "", None, " \n", "x " * 4000, "x " * 4000, passage[0]]
    ids = list(range(len(docs)))
    dice.shuffle(ids)
    rows = list(zip(ids, docs))
    return rows + rows[3:6] + [(None, docs[0]), (None, "only here one two three four"), (4, "other text of an id that is used twice")]


@pytest.mark.parametrize("seed, frequent, rounds", [(1, 1 << 20, 6), (2, 3, 0), (3, 0, 1), (4, 40, 6)])
def test_components(spark, monkeypatch, seed, frequent, rounds):
    monkeypatch.setattr(op, "STAR_ROUNDS", max(rounds, 1))
    monkeypatch.setattr(op, "GROUP", 2)
    monkeypatch.setattr(op, "BLOCK_SHINGLES", [500_000, 100, 300, 1][seed - 1])
    monkeypatch.setattr(op, "DENSE_AT_ONCE", 2_000)
    find = op.frequent_shingles
    monkeypatch.setattr(op, "frequent_shingles", lambda docs: find(docs, frequent))
    docs = _corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"n": F.lit(0), "cls": F.lit(1), "tokens": F.lit("t")})
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0, r[3])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in op.join(frame).collect()), key=key)
    assert got == sorted(_expected(docs), key=key)


def test_one_of_each_group_stays(spark):
    docs = _corpus(5)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("component", F.lit("mine"))
    kept = op.without_copies(frame)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == frame.columns and set(rows) <= set(docs)
    sets = [_set(t) for _, t in rows]
    links = [(i, j) for i, x in enumerate(sets) for j in range(i) if x and 100 * len(x & sets[j]) >= 80 * len(x | sets[j])]
    assert not links
    assert {i for i, n, c, _ in _expected(docs) if n and i is not None and i == c} == {i for i, t in rows if _set(t) and i is not None}
    assert sum(not s for s in sets) == sum(not _set(t) for _, t in docs)


def test_shingles_of_all_documents_are_counted(spark):
    """A shingle that only two documents share is in the order, whichever two they are; more documents give a later place."""
    twice = [f"pair {i} has these five words" for i in range(40)]
    texts = 2 * twice + [f"some words that many share {i}" for i in range(9)] + ["alone here with words of its own"]
    hashes, ranks = op.frequent_shingles(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"))
    shared = {tuple(t.split()[i:i + 5]) for t in twice for i in range(2)}
    assert len(hashes) == len(shared) + 1 and (np.diff(hashes.astype(object)) > 0).all()
    often = op.shingles(next(slices([pa.RecordBatch.from_pydict({"text": ["some words that many share"]})], "text"))[1])[0]
    assert hashes[np.argmax(ranks)] == often[0] and sorted(ranks) == list(range(1, len(hashes) + 1))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert op.join(frame).count() == 0 and op.without_copies(frame).count() == 0


def test_prefix_tree():
    dice = np.random.default_rng(1)
    for _ in range(40):
        sets = [np.unique(dice.integers(0, 60, dice.integers(1, 50))).astype(np.uint64) for _ in range(30)]
        sets += [sets[0][:-1], sets[0]]
        tree = op.PrefixTree()
        for i, s in enumerate(sets):
            if len(s):
                tree.add(s, i)
        for x in sets:
            if len(x):
                want = [i for i, s in enumerate(sets) if len(s) and 100 * len(np.intersect1d(x, s)) >= 80 * len(np.union1d(x, s))]
                assert sorted(tree.linked(x, 4)) == want
        some = [s for s in sets if len(s)]
        together = sorted((member, int(q)) for member, linked in tree.linked_with(some, 4) for q in linked)
        assert together == sorted((member, q) for q, x in enumerate(some) for member in tree.linked(x, 4))


def test_texts_go_to_workers_in_small_batches(spark, monkeypatch):
    docs = spark.range(0, 600, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 2500) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    with small_batches(spark):
        found = docs.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
    assert sum(r.rows for r in found) == 600 and max(r.bytes for r in found) < 2 * BATCH_BYTES < sum(r.bytes for r in found)

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    usual, seen = spark.conf.get(name), []
    monkeypatch.setattr(op, "stage", lambda df, *rest: seen.append(spark.conf.get(name)) or stage(df, *rest))
    some = docs.limit(3)
    assert op.join(some).count() == 3
    assert set(seen) == {str(BATCH_BYTES)} and spark.conf.get(name) == usual
    spark.conf.set(name, "1048576")  # a size the session chose stays
    try:
        seen.clear()
        assert op.join(some).count() == 3
        assert set(seen) == {"1048576"} and spark.conf.get(name) == "1048576"
    finally:
        spark.conf.unset(name)
