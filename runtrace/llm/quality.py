"""Quality rules: fixed rules first, then robust multivariate outliers per language and source.

Counts of every whole text are turned into five numbers: log words, log mean word length, and the square roots of the shares
of symbols, repeated lines and repeated words. Rows that pass the fixed rules are grouped by language and source (a null is a group
of its own); groups under `MIN_GROUP` rows are pooled by language, and those pools under it in one last pool.

Each group's centre and scatter are the minimum-covariance-determinant estimate over `KEPT_SHARE` of its rows: from medians
and median deviations, concentration steps keep the nearest rows by Mahalanobis distance and take their mean and
covariance. All rows take part in every step. The nearest rows are found by counting rows and adding up their numbers in narrow bins
of distance, so a step is one aggregation with partial sums and no group is gathered; numbers are whole 1024ths, so
sums don't depend on their order. Covariances have a floor, since most shares are zero. A row beyond the `CUTOFF` quantile
of chi-squared is rejected. A last pool under `MIN_FIT` rows has no estimate, and its rows are kept.

Null texts have no words and fail the fixed rules. Repeated rows are judged alike. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runtrace.llm.textbytes import UNSPACED, Slice, byte_set, mix, slices, windows
from runtrace.sources.staging import stage

MIN_GROUP = 200
MIN_FIT = 30
KEPT_SHARE = 0.75
STEPS = 5
CUTOFF = 0.99999
SCALE = 1024
NUMBERS = ("log_words", "log_length", "symbols", "dup_lines", "repeats")
#: The least standard deviation that a number is taken to have. For the last two, in a group without repeats, 46 % of repeated lines or
#: words alone are beyond the cutoff.
FLOORS = (0.25, 0.05, 0.06, 0.12, 0.12)
FEW_GROUPS = 20_000

_SYMBOLS = byte_set()
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _equal_in_text(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A class for each entry, equal for equal hashes of one text, and the size of each class."""
    _, classes, sizes = np.unique(mix(hashes + owners.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                                  return_inverse=True, return_counts=True)
    return classes, sizes


def count_slice(part: Slice) -> dict[str, np.ndarray]:
    starts, ends = part.runs(UNSPACED)
    owners = part.texts_of(starts)
    inside = UNSPACED[part.bytes] & ((part.bytes & 0xC0) != 0x80)
    before = np.concatenate([[0], np.cumsum(inside)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[part.bytes])])
    _, triple_owners, firsts = windows(part.hashes(starts, ends), owners, 3)
    repeated = np.zeros(len(starts) + 3, bool)
    if len(firsts):
        classes, sizes = _equal_in_text(_, triple_owners)
        again = firsts[sizes[classes] > 1]
        for k in range(3):
            repeated[again + k] = True
    breaks = np.flatnonzero(part.bytes == 0x0A)
    line_starts, line_owners = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else breaks, part.texts_of(breaks)
    words_before = np.searchsorted(starts, np.stack([line_starts, breaks]))
    full = words_before[1] > words_before[0]
    line_starts, line_ends, line_owners = line_starts[full], breaks[full], line_owners[full]
    dups = np.zeros(part.n)
    if len(line_starts):
        classes, sizes = _equal_in_text(part.hashes(line_starts, line_ends), line_owners)
        first = np.zeros(len(sizes), np.int64)
        first[classes[::-1]] = np.arange(len(classes))[::-1]
        dups = part.per_text(line_owners) - part.per_text(line_owners[first])
    return {
        "n_words": part.per_text(owners), "word_chars": before[part.ends] - before[part.starts],
        "n_symbols": symbols[part.ends] - symbols[part.starts], "n_dup_lines": dups,
        "n_repeat_words": part.per_text(owners, repeated[:len(starts)].astype(float)), "n_lines": part.per_text(line_owners),
    }


def text_counts(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Per row: keys, and the counts of its text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in slices(batches, text, lower=False):
            counts = count_slice(part)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keys)], *[pa.array(counts[c].astype(np.int64)) for c in COUNTS]], names=[*keys, *COUNTS])

    kinds = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys]
    return docs.select(*keys, text).mapInArrow(work, ", ".join(kinds + [f"{c} bigint" for c in COUNTS]))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _numbers() -> list[Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = (F.log(words), F.log(chars / words), F.sqrt(F.col("n_symbols") / chars),
              F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))), F.sqrt(F.col("n_repeat_words") / words))
    return [F.round(v * SCALE).cast("bigint").alias(n) for v, n in zip(values, NUMBERS)]


def _grouped(counts: DataFrame) -> DataFrame:
    """Rows that pass the fixed rules, with their group: language and source, or a pool."""
    rows = counts.where(~base_failed()).select("row", "lang", "source", *_numbers())
    sizes = rows.groupBy("lang", "source").count()
    pools = sizes.withColumn("small", F.col("count") < MIN_GROUP)
    pools = pools.withColumn("pool", F.sum(F.when(F.col("small"), F.col("count"))).over(Window.partitionBy("lang")))
    name = F.to_json(F.when(~F.col("small"), F.array("lang", "source")).when(F.col("pool") >= MIN_GROUP, F.array("lang")).otherwise(F.array()))
    groups = stage(pools.select(F.col("lang").alias("l"), F.col("source").alias("s"), name.alias("group")), "quality-groups")
    if groups.count() <= FEW_GROUPS:
        groups = F.broadcast(groups)
    joined = rows.join(groups, rows["lang"].eqNullSafe(groups["l"]) & rows["source"].eqNullSafe(groups["s"]))
    return joined.select("row", "group", *NUMBERS)


def _precision(scatter: np.ndarray) -> np.ndarray:
    """Inverse of covariances, in 1024ths, with floors added to the variances."""
    return np.linalg.inv(scatter + np.diag([(f * SCALE) ** 2 for f in FLOORS]))


_MODEL = "group string, n bigint, centre array<double>, precision array<double>"
_PAIRS = [(i, j) for i in range(len(NUMBERS)) for j in range(i, len(NUMBERS))]


def _distance() -> Column:
    """Squared Mahalanobis distance of a row to the centre of its model."""
    gaps = [F.col(n) - F.col("centre")[i] for i, n in enumerate(NUMBERS)]
    p = len(NUMBERS)
    return sum((gaps[i] * gaps[j] * F.col("precision")[i * p + j] * (1 if i == j else 2) for i, j in _PAIRS), F.lit(0.0))


def _with_model(rows: DataFrame, model: DataFrame) -> DataFrame:
    if model.count() <= FEW_GROUPS:
        model = F.broadcast(model)
    return rows.join(model, "group").withColumn("d2", _distance())


def _start(rows: DataFrame) -> DataFrame:
    """Centres and scatters from medians and median deviations."""
    middle = rows.groupBy("group").agg(F.count("*").alias("n"), *[F.percentile_approx(c, 0.5).alias(f"m_{c}") for c in NUMBERS])
    middle = stage(middle, "quality-middle")
    few = F.broadcast(middle) if middle.count() <= FEW_GROUPS else middle
    spread = rows.join(few, "group").groupBy("group").agg(
        *[F.percentile_approx(F.abs(F.col(c) - F.col(f"m_{c}")), 0.5).alias(f"d_{c}") for c in NUMBERS])

    def work(frames):
        for frame in frames:
            yield pd.DataFrame([
                {"group": r.group, "n": r.n, "centre": [float(getattr(r, f"m_{c}")) for c in NUMBERS],
                 "precision": _precision(np.diag([(1.4826 * getattr(r, f"d_{c}")) ** 2 for c in NUMBERS])).ravel().tolist()}
                for r in frame.itertuples()], columns=["group", "n", "centre", "precision"])

    return stage(middle.join(spread, "group").where(F.col("n") >= MIN_FIT).mapInPandas(work, _MODEL), "quality-model")


def chi_squared(share: float, p: int) -> float:
    """Quantile of chi-squared by the cube-root normal approximation."""
    low, high = -10.0, 10.0
    for _ in range(80):
        z = (low + high) / 2
        low, high = (z, high) if 0.5 * math.erfc(-z / math.sqrt(2)) < share else (low, z)
    return p * (1 - 2 / (9 * p) + low * math.sqrt(2 / (9 * p))) ** 3


def _bin() -> Column:
    """Bins of distance: eight for each doubling."""
    return F.floor(F.log2(F.col("d2") + 2.0**-10) * 8).cast("int")


def _consistency(share: float, p: int) -> float:
    """What the covariance of the nearest share of normal rows is to be multiplied with."""
    dice = np.random.default_rng(3).chisquare(p, 400_000)
    near = np.sort(dice)[: int(share * len(dice))]
    return p / near.mean()


def _concentrate(rows: DataFrame, model: DataFrame) -> DataFrame:
    """One step: mean and covariance of the nearest rows of each group."""
    p = len(NUMBERS)
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(NUMBERS)]
    products = [F.sum(F.col(NUMBERS[i]) * F.col(NUMBERS[j])).alias(f"p{i}{j}") for i, j in _PAIRS]
    bins = _with_model(rows, model).groupBy("group", "n", _bin().alias("bin")).agg(F.count("*").alias("rows"), *sums, *products)
    nearer = F.coalesce(F.sum("rows").over(Window.partitionBy("group").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = bins.withColumn("nearer", nearer).where(F.col("nearer") < KEPT_SHARE * F.col("n"))
    names = ["rows", *[f"s{i}" for i in range(p)], *[f"p{i}{j}" for i, j in _PAIRS]]
    totals = kept.groupBy("group", "n").agg(*[F.sum(c).alias(c) for c in names])
    factor = _consistency(KEPT_SHARE, p)

    def work(frames):
        for frame in frames:
            out = []
            for r in frame.itertuples():
                centre = np.array([getattr(r, f"s{i}") for i in range(p)], float) / r.rows
                scatter = np.zeros((p, p))
                for i, j in _PAIRS:
                    scatter[i, j] = scatter[j, i] = getattr(r, f"p{i}{j}") / r.rows - centre[i] * centre[j]
                out.append({"group": r.group, "n": r.n, "centre": centre.tolist(), "precision": _precision(factor * scatter).ravel().tolist()})
            yield pd.DataFrame(out, columns=["group", "n", "centre", "precision"])

    return stage(totals.mapInPandas(work, _MODEL), "quality-model")


def judge(docs: DataFrame, steps: int = STEPS) -> DataFrame:
    """Per row of docs (doc_id, text, lang, source): doc_id, counts, base_failed, group, distance, kept."""
    counts = stage(text_counts(docs, ["doc_id", "lang", "source"]).withColumn("row", F.monotonically_increasing_id()), "quality-counts")
    rows = stage(_grouped(counts), "quality-rows")
    model = _start(rows)
    for _ in range(steps):
        model = _concentrate(rows, model)
    limit = chi_squared(CUTOFF, len(NUMBERS))
    judged = _with_model(rows, model).select("row", "group", F.sqrt("d2").alias("distance"))
    out = counts.join(judged, "row", "left")
    inlier = F.col("distance").isNull() | (F.col("distance") <= math.sqrt(limit))
    return out.select("doc_id", *COUNTS, base_failed().alias("base_failed"), "group", "distance", (~base_failed() & inlier).alias("kept"))
