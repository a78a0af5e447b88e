"""Exact places of rows in an order within groups, without gathering a group in one task.

Rows are dealt by ranges of (group, order), stored, and counted per group and range; a range's rows then stand behind those of
the ranges before it. A group of any size is spread over its ranges. Equal rows stand in any order beside each other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runtrace.sources.staging import stage


@dataclass(frozen=True)
class Ordered:
    """`groups`: the group columns, `group_no`, `group_total` (weight) and `group_size` (rows). `starts`: a row for each group and range."""

    stored: DataFrame
    starts: DataFrame
    groups: DataFrame
    by: list[str]
    order: list[str]
    weight: str | None

    def rows(self, facts: DataFrame | None = None) -> DataFrame:
        """The rows with `group_no`, `place` (weight before a row in its group) and `rank` (rows before it), and with the
        facts about their group (by `group_no`)."""
        starts = self.starts if facts is None else self.starts.join(facts, "group_no")
        names = {name: f"{name}__" for name in [*self.by, "range__no"]}
        few = starts.withColumnsRenamed(names)
        same = [self.stored[old].eqNullSafe(few[new]) for old, new in names.items()]
        here = Window.partitionBy(*self.by, "range__no").orderBy(*self.order, "tie__").rowsBetween(Window.unboundedPreceding, 0)
        weight = _weight(self.weight)
        joined = self.stored.join(few, same).drop(*names.values())
        placed = joined.withColumns({"place": F.sum(weight).over(here), "rank": F.count("*").over(here)})
        return placed.withColumns({
            "place": F.col("weight_ahead__") + F.col("place") - weight, "rank": F.col("rows_ahead__") + F.col("rank") - 1,
        }).drop("weight_ahead__", "rows_ahead__", "tie__", "range__no", "whole__")


def _weight(name: str | None) -> Column:
    return F.lit(1).cast("bigint") if name is None else F.coalesce(F.col(name), F.lit(0))


def ordered(rows: DataFrame, by: list[str], order: list[str], weight: str | None = None, nulls_last: bool = False,
            name: str = "ordered") -> Ordered:
    """Deal rows by (group, order). Groups are numbered in the order of their columns, nulls first unless `nulls_last`."""
    if not by:
        rows, by = rows.withColumn("whole__", F.lit(0)), ["whole__"]
    keys = [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc() for c in by]
    tied = rows.withColumn("tie__", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*keys, *order, "tie__").withColumn("range__no", F.spark_partition_id())
    stored = stage(dealt, name)
    counts = stage(stored.groupBy(*by, "range__no").agg(F.sum(_weight(weight)).alias("weight"), F.count("*").alias("n")), f"{name}-counts")
    before = Window.partitionBy(*by).orderBy("range__no").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(*by, "range__no", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(a)
                                              for c, a in (("weight", "weight_ahead__"), ("n", "rows_ahead__"))])
    whole = counts.groupBy(*by).agg(F.sum("weight").alias("group_total"), F.sum("n").alias("group_size"), F.min("range__no").alias("first"))
    begun = whole.groupBy("first").agg(F.count("*").alias("begun"))
    lower = begun.select("first", F.coalesce(F.sum("begun").over(
        Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("lower"))  # one row a range
    in_range = F.row_number().over(Window.partitionBy("first").orderBy(*keys))
    groups = stage(whole.join(lower, "first").withColumn("group_no", F.col("lower") + in_range - 1).select(
        *by, F.col("group_no").cast("bigint").alias("group_no"), "group_total", "group_size"), f"{name}-groups")
    few = groups.withColumnsRenamed({c: f"{c}__" for c in by})
    starts = ahead.join(few, [ahead[c].eqNullSafe(few[f"{c}__"]) for c in by])
    return Ordered(stored, starts.drop(*[f"{c}__" for c in by]), groups, by, order, weight)
