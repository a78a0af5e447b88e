"""From raw documents to pieces: language, copies, benchmark passages, secrets, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of documents. `run` writes each result as Parquet to the folder that executors share and reads it again.
Python workers stay from stage to stage, so every stage asks for small Arrow batches; its rows are made when its result is
written, so the setting outlives the stage, but not `run`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtrace.llm import decontaminate, jaccard_join, language_id, pieces, secrets
from runtrace.llm.rows import table
from runtrace.sources.staging import keep_batches_small, new_folder, released, small_batches

#: SQL can't express the language model, the Markov models or the segmentation; tests compare with plain Python.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter that are not too far from every language; the model learns from all labelled rows."""
    keep_batches_small(spark)
    return language_id.without_rejected(docs, language_id.train(docs, F.lit(True)))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    keep_batches_small(spark)
    return jaccard_join.without_copies(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are in benchmark windows."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of each secret in its place."""
    keep_batches_small(spark)
    return secrets.redact(docs, secrets.train(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document: doc_id, n_pieces, ids, ids_sha256, score, n_best, round_trip."""
    keep_batches_small(spark)
    return pieces.encode(docs, pieces.load())


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", first_copies),
    ("decontaminate", clean_of_benchmarks),
    ("secrets", redacted),
    ("pieces", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another. What a stage stages for itself is removed when its result is stored."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        with released(spark), small_batches(spark):
            found = work(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs
