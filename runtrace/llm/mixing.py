"""A mix of sources by weight: a fixed schedule of slots, each filled with one block of a source's shuffled words.

Sources are ordered by code point, null last. Their weights are `WEIGHTS`, repeating. A source's target is its share of all
words by weight, at most `CAP` times its own size; what is above is shared again by weight until no target is above.

The schedule has 2^m slots. The van der Corput point of a slot, its number with m bits in reverse, is mapped through the sources'
cumulative slot counts; since the points of 2^m slots are the whole numbers below 2^m, every source gets exactly its count, and any
stretch of slots is near its shares. Slots of a source are ranked by number. A source's documents are shuffled by a digest of their
id and laid end to end, once for each pass over them; the words up to the target are cut into as many equal blocks as the source
has slots (some differ by one word), and slot r takes block r. So a source gives its target, rounded down, and a document at most
CAP times its size. Places of documents and ranks of slots are counted by ranges (`order.py`): no source is gathered.

Words are `[^\\x20\\x09-\\x0D]+`. Null and empty texts have no words and are never taken. Repeated rows, and rows with one doc_id, are
documents of their own. A source without words has target 0. An empty table has an empty mix. Very long texts span several
blocks. Other columns are neither read nor kept. The same table, weights and seed give the same mix.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace.llm.order import Ordered, ordered
from runtrace.sources.staging import stage

WEIGHTS = (5, 2, 1)
CAP = 3
#: Words in a block, about, and the least number of slots.
BLOCK_WORDS = 65_536
LEAST_SLOTS = 1_024
SEED = "mix"
#: Points in one cell of the join of points to sources: a cell holds at most as many of either.
CELL = 64


@dataclass(frozen=True)
class Mix:
    """`documents`: row, doc_id, source, size, source_size, target. `spans`: slot, at, row, doc_id, source, begin, end.

    `row` numbers the rows of a table. A span is the words of a document from `begin` up to, not including, `end`; in a slot they
    stand in the order of `at`, their place in what their source gives.
    """

    documents: DataFrame
    spans: DataFrame
    n_slots: int


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _targets(groups: DataFrame, weights: tuple, cap: int) -> DataFrame:
    """Sources with their weight and target. Only sums reach the driver; each turn fills sources, so they end."""
    rated = groups.withColumn("weight", F.element_at(F.lit(list(weights)), (F.col("group_no") % len(weights) + 1).cast("int")).cast("bigint"))
    limit = cap * F.col("group_total")
    total = rated.agg(F.sum("group_total")).first()[0] or 0
    level, filled = 0.0, -1
    while True:
        full = limit <= F.col("weight") * F.lit(level)
        found = rated.agg(F.count_if(full).alias("filled"), F.sum(F.when(full, limit)).alias("given"), F.sum(F.when(~full, F.col("weight"))).alias("left")).first()
        if found["filled"] == filled or not found["left"]:
            break
        filled = found["filled"]
        level = (total - (found["given"] or 0)) / found["left"]
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(level))
    return rated.withColumn("target", target)


def _scaled(a: str, b: str, c: str) -> Column:
    """a * b div c in whole numbers of any size."""
    return F.expr(f"(cast({a} as decimal(19, 0)) * cast({b} as decimal(19, 0))) div {c}")


def _shares(sources: DataFrame, n_slots: int, count: int) -> DataFrame:
    """Sources that give words (source_no, source_size, taken) with their `n` slots, from point `first` up to `after`: one at least."""
    laid = ordered(sources, [], ["source_no"], "taken", name="mix-shares").rows()
    free = str(n_slots - count)
    laid = laid.withColumns({"first": F.col("rank") + _scaled("place", free, "group_total"),
                             "after": F.col("rank") + 1 + _scaled("(place + taken)", free, "group_total")})
    return laid.select("source_no", "source_size", "taken", "first", "after", (F.col("after") - F.col("first")).alias("n"))


def _slots(shares: DataFrame, n_slots: int) -> DataFrame:
    """(source_no, rank, slot): the slots of every source in their order."""
    bits = n_slots.bit_length() - 1
    point = F.conv(F.reverse(F.lpad(F.bin("id"), bits, "0")), 2, 10).cast("bigint")
    points = shares.sparkSession.range(n_slots).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.expr(f"point div {CELL}"))
    cells = shares.select("source_no", "first", "after", F.explode(F.expr(f"sequence(first div {CELL}, (after - 1) div {CELL})")).alias("cell"))
    mapped = points.join(cells, "cell").where("point >= first AND point < after").select("source_no", "slot")
    return ordered(mapped, ["source_no"], ["slot"], name="mix-slots").rows().select("source_no", "rank", "slot")


def _blocks(laid: DataFrame) -> DataFrame:
    """Documents (row, place, size and facts of their source) in the blocks of their source: begin and end in the document."""
    passes = F.explode(F.expr("sequence(0L, (taken - 1) div source_size)")).alias("pass")
    laid = laid.select("*", passes).withColumn("at", F.col("place") + F.col("pass") * F.col("source_size"))
    laid = laid.withColumn("stop", F.least(F.col("at") + F.col("size"), F.col("taken"))).where("at < stop")
    of = lambda place: f"((cast({place} as decimal(19, 0)) * n - 1) div taken)"  # noqa: E731  the block that holds the word before a place
    laid = laid.select("*", F.explode(F.expr(f"sequence({of('at + 1')}, {of('stop')})")).alias("block"))
    begin = F.greatest(F.col("at"), _scaled("block", "taken", "n")) - F.col("at")
    end = F.least(F.col("stop"), _scaled("(block + 1)", "taken", "n")) - F.col("at")
    return laid.select("source_no", F.col("block").alias("rank"), "row", "doc_id", "source", (F.col("at") + begin).alias("at"), begin.alias("begin"), end.alias("end")).where("begin < end")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP, seed: str = SEED, block_words: int = BLOCK_WORDS,
        least_slots: int = LEAST_SLOTS) -> Mix:
    """Mix all documents (doc_id, text, source)."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), key.alias("key"))
    laid: Ordered = ordered(sized, ["source"], ["key", "doc_id", "size"], "size", nulls_last=True, name="mix-documents")
    targets = stage(_targets(laid.groups, weights, cap).withColumn("taken", F.floor("target").cast("bigint")), "mix-targets")
    giving = targets.where("taken > 0").select(F.col("group_no").alias("source_no"), F.col("group_total").alias("source_size"), "taken")
    total, count = giving.agg(F.sum("taken"), F.count("*")).first()
    n_slots = 1 << math.ceil(math.log2(max((total or 0) / block_words, least_slots, 2 * count)))
    shares = stage(_shares(giving, n_slots, count), "mix-slot-counts")
    rows = laid.rows(targets.select("group_no", "target"))
    rows = stage(rows.select(F.struct("group_no", "rank").alias("row"), "doc_id", "source", "size", F.col("group_no").alias("source_no"), "place",
                             F.col("group_total").alias("source_size"), "target"), "mix-rows")
    blocks = _blocks(rows.where("size > 0").join(shares.select("source_no", "taken", "n"), "source_no"))
    spans = blocks.join(_slots(shares, n_slots), ["source_no", "rank"]).select("slot", "at", "row", "doc_id", "source", "begin", "end")
    return Mix(rows.select("row", "doc_id", "source", "size", "source_size", "target"), spans, n_slots)


def taken(mixed: Mix) -> DataFrame:
    """The documents with `taken`: their words in the mix, repeats counted."""
    words = mixed.spans.groupBy("row").agg(F.sum(F.col("end") - F.col("begin")).alias("taken"))
    return mixed.documents.join(words, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("bigint")))
