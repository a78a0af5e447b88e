"""Compare two copies of the same metrics."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ["row_count", *[f"metric_{i}_count" for i in range(1, 6)]]


class ReconcileInputError(ValueError):
    """The rows cannot be compared: a column is absent or a key occurs twice."""


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return _lower(rows).groupBy(*[k.lower() for k in keys]).agg(F.count("*").alias("row_count")).where("row_count > 1")


def metric_differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    tolerance: Decimal = Decimal("0.01"),
) -> DataFrame:
    """(key, column, left_value, right_value, reason) for every difference between two copies.

    Column names match in any case; keys match as text, with NULL equal to NULL; numbers may come as text.
    A key only one side has gives one row with column "*". Keys must be unique on each side, which keeps the
    full outer join free of hot keys: see `reconcile`.
    """
    if not keys:
        raise ReconcileInputError("comparison needs key columns")
    if tolerance < 0:
        raise ReconcileInputError("tolerance must not be negative")
    keys, metrics = [k.lower() for k in keys], [m.lower() for m in metrics]
    sides = {"l": _lower(left), "r": _lower(right)}
    for side in sides.values():
        absent = [name for name in (*keys, *metrics) if name not in side.columns]
        if absent:
            raise ReconcileInputError(f"columns are missing: {', '.join(absent)}")

    def prepared(prefix: str) -> DataFrame:
        return sides[prefix].select(
            *[F.col(k).cast("string").alias(f"{prefix}_key_{i}") for i, k in enumerate(keys)],
            *[F.col(m).cast("decimal(38,6)").alias(f"{prefix}_{m}") for m in metrics],
            F.lit(True).alias(f"{prefix}_there"),
        )

    def key(i: int) -> tuple[Column, Column]:
        return F.col(f"l_key_{i}"), F.col(f"r_key_{i}")

    same_key = reduce(lambda a, b: a & b, [key(i)[0].eqNullSafe(key(i)[1]) for i in range(len(keys))])
    joined = prepared("l").join(prepared("r"), same_key, "full_outer")
    in_left, in_right = F.col("l_there").isNotNull(), F.col("r_there").isNotNull()

    def difference(name: str, reason: str) -> Column:
        left_value, right_value = (
            (F.lit(None).cast("decimal(38,6)"),) * 2 if name == "*" else (F.col(f"l_{name}"), F.col(f"r_{name}"))
        )
        return F.struct(
            F.lit(name).alias("column"),
            left_value.alias("left_value"),
            right_value.alias("right_value"),
            F.lit(reason).alias("reason"),
        )

    def apart(name: str) -> Column:
        left_value, right_value = F.col(f"l_{name}"), F.col(f"r_{name}")
        far = F.coalesce(F.abs(left_value - right_value) > F.lit(tolerance), F.lit(True))
        return in_left & in_right & far & ~left_value.eqNullSafe(right_value)

    found = F.array_compact(
        F.array(
            F.when(~in_left, difference("*", "missing_in_left")),
            F.when(~in_right, difference("*", "missing_in_right")),
            *[F.when(apart(name), difference(name, "value_mismatch")) for name in metrics],
        )
    )
    parts = [F.when(in_left, key(i)[0]).otherwise(key(i)[1]) for i in range(len(keys))]
    return joined.select(F.array(*parts).alias("key"), F.explode(found).alias("d")).select("key", "d.*")


def reconcile(left, right, keys, metrics, tolerance: Decimal = Decimal("0.01")) -> DataFrame:
    """`metric_differences` after making sure that no key occurs twice on either side."""
    differences = metric_differences(left, right, keys, metrics, tolerance)
    for side in (left, right):
        twice = duplicate_keys(side, keys).first()
        if twice is not None:
            raise ReconcileInputError(f"key occurs more than once: {tuple(twice)[:-1]}")
    return differences


def metric_summaries(gold: dict[str, DataFrame]) -> DataFrame:
    """Six Gold tables as a handful of checksum rows: (dataset_key, row_count, five metrics)."""

    def count(condition: str) -> Column:
        return F.count_if(F.expr(condition))

    datasets = {
        "run_progression": ["started_run_count", "reached_run_count", "previous_reached_run_count",
                            count("reached_run_count < previous_reached_run_count"),
                            count("step_dropoff_percentage > 0")],
        "item_performance_summary": ["selection_count", "selected_run_count", "outcome_observed_run_count",
                                     "death_within_60_seconds_count",
                                     count("analysis_status = 'INSUFFICIENT_SAMPLE'")],
        "weapon_popularity": ["starting_run_count", "exposure_count", "selection_count", "first_selected_run_count",
                              count("selection_percentage > 0")],
        "weapon_performance": ["run_count", "outcome_observed_run_count", "average_total_kills",
                               count("analysis_status = 'INSUFFICIENT_SAMPLE'"), count("death_percentage > 0")],
        "option_outcome_comparison": ["offered_run_count", "selected_run_count", "not_selected_run_count",
                                      "selected_outcome_run_count", "not_selected_outcome_run_count"],
    }

    def metrics(measures: list) -> list[Column]:
        sums = [F.sum(m) if isinstance(m, str) else m for m in measures]
        return [
            F.count("*").alias("row_count"),
            *[F.coalesce(s, F.lit(0)).cast("decimal(38,2)").alias(f"metric_{i}_count") for i, s in enumerate(sums, 1)],
        ]

    by_status = gold["run_quality"].groupBy(F.concat(F.lit("run_quality:"), "run_status").alias("dataset_key")).agg(
        *metrics(["run_count", "input_event_count", "unique_event_count", "exact_retry_count",
                  "conflicting_duplicate_count"])
    )
    parts = [gold[name].agg(*metrics(measures)).withColumn("dataset_key", F.lit(name))
             for name, measures in datasets.items()]
    return reduce(DataFrame.unionByName, parts, by_status).select("dataset_key", *METRICS)
