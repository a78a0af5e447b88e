"""Benchmark decontamination with DataFrame functions only.

Words are runs of characters other than ASCII that is neither digit nor letter, A-Z lower-cased. A window is 13
consecutive words of a benchmark item; an item of fewer words, but not none, is one window. Every window has an anchor,
its longest word (the first of these). The windows, keyed by anchor, are broadcast in blocks of at most `WINDOWS_AT_ONCE`, so their
size is bounded whatever the benchmark; words of whole documents meet them in a hash join, and a meeting is a hit only
if the document's words around it equal the window. Only hits are shuffled, by document.

Documents are told apart by id and text, so repeated rows have equal results. Null texts and texts without words have no
hits; an empty benchmark hits nothing. Items with a null id count as one item with the empty id; equal ids are one item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runtrace.llm.rows import same_text, without
from runtrace.sources.staging import stage

#: Digits, letters and all beyond ASCII, named one by one: Java's regex takes three times as long for what several negated ranges leave.
WORD = "[0123456789abcdefghijklmnopqrstuvwxyz" r"\x{80}-\x{10FFFF}]+"
#: The same words before A-Z are lower-cased.
CASED_WORD = "[ABCDEFGHIJKLMNOPQRSTUVWXYZ" + WORD[1:]
WINDOW_WORDS = 13
WINDOWS_AT_ONCE = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: words, ids of the items that hold them, anchor and its place in the window."""
    words = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words_of(text).alias("words"))
    places = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW_WORDS - 1), F.lit(1)))
    windows = words.where(F.size("words") > 0).select("item", F.explode(F.transform(
        places, lambda i: F.slice("words", i, F.lit(WINDOW_WORDS)))).alias("window"))
    longest = F.array_max(F.transform("window", lambda w, i: F.struct(F.length(w).alias("n"), (-i).alias("back"), w.alias("word"))))
    return (
        windows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
        .withColumn("longest", longest)
        .select("window", "items", F.col("longest.word").alias("anchor"), (-F.col("longest.back")).alias("place"))
    )


def find_hits(docs: DataFrame, windows: DataFrame, at_once: int = WINDOWS_AT_ONCE) -> DataFrame:
    """Occurrences of windows in documents (columns doc_id, text): doc_id, text_hash, start, n, items."""
    blocks = max(1, -(-windows.count() // at_once))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of("text").alias("words"))
    tokens = rows.select("*", F.posexplode("words").alias("pos", "word"))

    def hits(block: int) -> DataFrame:
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block) if blocks > 1 else windows
        first = F.col("pos") - F.col("place")
        around = F.slice("words", F.greatest(first + 1, F.lit(1)), F.size("window"))
        met = tokens.join(F.broadcast(part), (F.col("word") == F.col("anchor")) & (first >= 0) & (around == F.col("window")))
        return met.select("doc_id", "text_hash", first.alias("start"), F.size("window").alias("n"), "items")

    return reduce(DataFrame.unionByName, map(hits, range(blocks)))


def contamination(docs: DataFrame, benchmark: DataFrame, at_once: int = WINDOWS_AT_ONCE) -> DataFrame:
    """Per document row: doc_id, text_hash, n_words, n_hit, items (ids as sorted strings), spans of hit words."""
    hits = find_hits(docs, benchmark_windows(benchmark), at_once)
    by_document = Window.partitionBy("doc_id", "text_hash").orderBy("start", "n")
    before = F.max(F.col("start") + F.col("n")).over(by_document.rowsBetween(Window.unboundedPreceding, -1))
    first = F.greatest("start", F.coalesce(before, F.lit(0)))
    fresh = F.greatest(F.col("start") + F.col("n") - first, F.lit(0)).cast("bigint")
    found = (
        hits.withColumns({"first": first, "fresh": fresh})
        .groupBy("doc_id", "text_hash")
        .agg(F.sum("fresh").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
             F.sort_array(F.collect_list(F.when(F.col("fresh") > 0, F.struct("first", "fresh")))).alias("spans"))
    )
    n_words = F.coalesce(F.regexp_count("text", F.lit(CASED_WORD)), F.lit(0)).cast("bigint")
    counted = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), n_words.alias("n_words"))
    same = counted["doc_id"].eqNullSafe(found["doc_id"]) & (counted["text_hash"] == found["text_hash"])
    joined = counted.join(found, same, "left")
    return joined.select(
        counted["doc_id"], counted["text_hash"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,fresh:bigint>>")).alias("spans"))


def is_contaminated() -> Column:
    """One word in twenty, and at least one, is in an occurrence of a window."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Document rows that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark).where(is_contaminated()).select("doc_id", "text_hash").distinct()
    return without(docs, stage(bad, "contaminated"))


def without_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every document row with its hit words cut out of the text; what stands between words stays."""
    found = contamination(docs, benchmark).where("n_hit > 0").select("doc_id", "text_hash", "spans").dropDuplicates(["doc_id", "text_hash"])
    found = stage(found.select("doc_id", "text_hash", "spans"), "hit-spans")
    words, gaps = F.regexp_extract_all(docs["text"], F.lit(CASED_WORD), F.lit(0)), F.split(docs["text"], CASED_WORD, -1)
    places = F.flatten(F.transform(found["spans"], lambda s: F.sequence(s["first"].cast("bigint"), s["first"] + s["fresh"] - 1)))
    kept = F.transform(words, lambda w, i: F.concat(
        F.when(F.array_contains(places, i.cast("bigint")), F.lit("")).otherwise(w), F.element_at(gaps, i + 2)))
    cut = F.concat(F.element_at(gaps, 1), F.array_join(kept, ""))
    text = F.when(found["spans"].isNull(), docs["text"]).otherwise(cut)
    joined = docs.join(found, same_text(docs, found), "left")
    return joined.select(*[(text.alias(c) if c == "text" else docs[f"`{c}`"]) for c in docs.columns])
