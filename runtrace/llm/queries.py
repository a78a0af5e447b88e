"""The queries of this subpackage: each applies one operator to its whole table and derives the digests of its contract."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runtrace.llm import chat_format, decontaminate, jaccard_join, language_id, lm, merkle, mixing, periods, pieces, quality, secrets, toxicity, warc
from runtrace.llm.rows import remainder, table
from runtrace.sources.staging import stage


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 4) == 2
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("sentences").alias("n_offending"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    records = chat_format.records_of_turns(rows)
    return chat_format.digest_formatted(chat_format.format_records(records, "conv_id", "record"), "conv_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = stage(warc.write_bundles(table(spark, sf_dir, "pages")), "warc")
    return warc.read_bundles(bundles, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.train(docs))

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = remainder("doc_id", 5)
    model = language_id.train(docs, rest != 0)
    found = language_id.predict(docs, model)
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 7) == 2
    return lm.score(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, pieces.load(), with_ids=False)
    return found.select("doc_id", "n_pieces", "ids_sha256", "score", F.array_join(F.col("n_best.score").cast("array<string>"), ",").alias("n_best_scores"),
                        F.array_join("n_best.ids_sha256", ",").alias("n_best_sha256"), "round_trip")


def with_period(doc_id, words: list) -> list:
    """Of every tenth id by crc32, words from some place on replaced by a stretch that repeats."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    return words[:at] + (words[at:at + period] * (1 + (n - at) // period))[:n - at]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), words_of=with_period)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixing.taken(mixed).select("doc_id", "size", "source_size", "target", "taken")


def without_breaks() -> Column:
    """The text that a tampered store would hold: of every second id by crc32, without line feeds."""
    return F.when(remainder("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.COLUMNS)
    return merkle.verified(merkle.manifest(docs, without_breaks())).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")
