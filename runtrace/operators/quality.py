"""The quality gate: twelve checks over the Gold tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.operators.gold_items import ITEM_KEY, uncatalogued_items
from runtrace.sources.staging import stage

_COUNTERS = ["input_event_count", "unique_event_count", "exact_retry_count", "conflicting_duplicate_count"]


class QualityGateError(RuntimeError):
    """At least one check failed, so nothing may be published."""


def _negative(*names: str) -> list[Column]:
    return [F.col(name) < 0 for name in names]


def _below_one(*names: str) -> list[Column]:
    return [F.col(name) < 1 for name in names]


def _over_hundred(*names: str) -> list[Column]:
    return [(F.col(name) < 0) | (F.col(name) > 100) for name in names]


def _absent(*names: str) -> list[Column]:
    return [F.col(name).isNull() for name in names]


def _rising(*names: str) -> list[Column]:
    """Each measure may be at most the next one."""
    return [F.col(low) > F.col(high) for low, high in zip(names, names[1:])]


def _status(*observed: str) -> list[Column]:
    """The sample status must say what the observed counts say."""
    short = reduce(lambda a, b: a | b, [F.col(name) < contract.MIN_SAMPLE for name in observed])
    enough = reduce(lambda a, b: a & b, [F.col(name) >= contract.MIN_SAMPLE for name in observed])
    status = F.col("analysis_status")
    return [
        ~status.isin("INSUFFICIENT_SAMPLE", "DESCRIPTIVE_ONLY"),
        short & (status != "INSUFFICIENT_SAMPLE"),
        enough & (status != "DESCRIPTIVE_ONLY"),
    ]


def _after_pick() -> list[Column]:
    return [
        *_below_one("selection_count", "selected_run_count"),
        *_rising("selected_run_count", "selection_count"),
        *_negative("outcome_observed_run_count", "death_within_60_seconds_count"),
        *_rising("death_within_60_seconds_count", "outcome_observed_run_count", "selected_run_count"),
        *_over_hundred("death_within_60_seconds_percentage"),
        *_negative("average_seconds_after_selection", "average_final_level", "average_total_kills"),
        *_status("outcome_observed_run_count"),
    ]


def row_rules() -> dict[str, tuple[str, list[Column]]]:
    """Check name -> (Gold table, what no row may show). A condition that is unknown for a row does not fail it."""
    ended = F.col("is_ended")
    outcome = ["end_reason", "run_duration_seconds", "final_level", "total_kills", "current_gold"]
    accounted = F.col("unique_event_count") + F.col("exact_retry_count") + F.col("conflicting_duplicate_count")
    return {
        "run_quality_non_negative": ("run_quality", _negative("run_count", *_COUNTERS)),
        "run_summary_consistency": (
            "run_summary",
            [
                ended & (F.col("run_status") != contract.VALID),
                ~ended & (F.col("run_status") != contract.INCOMPLETE),
                *[ended & missing for missing in _absent(*outcome)],
                F.col("death_cause").isNotNull() & (F.col("end_reason") != "player_death"),
                *_rising("upgrade_selected_count", "upgrade_shown_count"),
                F.col("input_event_count") != accounted,
            ],
        ),
        "checkpoint_value_ranges": (
            "checkpoint_metrics",
            [
                *_below_one("checkpoint_number", "checkpoint_event_count"),
                *_negative("average_player_level", "average_current_xp", "average_total_kills", "average_current_gold"),
                F.col("average_xp_to_next_level") <= 0,
                *_over_hundred("average_hp_percent"),
            ],
        ),
        "run_progression_ranges": (
            "run_progression",
            [
                *_below_one("checkpoint_number", "started_run_count"),
                F.col("elapsed_minutes") != F.col("checkpoint_number"),
                *_negative("reached_run_count"),
                *_rising("reached_run_count", "previous_reached_run_count", "started_run_count"),
                *_over_hundred("reach_percentage", "step_dropoff_percentage"),
            ],
        ),
        "upgrade_post_selection_ranges": ("upgrade_post_selection", _after_pick()),
        "item_performance_summary_ranges": (
            "item_performance_summary",
            [
                *_absent("display_name", "item_category", "intended_effect", "primary_metric", "metric_readiness"),
                *_after_pick(),
            ],
        ),
        "weapon_popularity_ranges": (
            "weapon_popularity",
            [
                *_absent("display_name"),
                *_negative("starting_run_count", "exposure_count", "exposed_run_count", "selection_count",
                           "selected_run_count", "first_selected_run_count"),
                *_rising("exposed_run_count", "exposure_count"),
                *_rising("first_selected_run_count", "selected_run_count", "selection_count", "exposure_count"),
                *_over_hundred("selection_percentage"),
            ],
        ),
        "weapon_performance_ranges": (
            "weapon_performance",
            [
                *_absent("display_name"),
                *_below_one("run_count"),
                *_negative("outcome_observed_run_count", "average_run_seconds", "average_total_kills",
                           "kills_per_minute", "average_final_level", "average_total_xp", "average_total_gold"),
                *_rising("outcome_observed_run_count", "run_count"),
                *_over_hundred("death_percentage"),
                *_status("outcome_observed_run_count"),
            ],
        ),
        "option_outcome_comparison_ranges": (
            "option_outcome_comparison",
            [
                *_absent("display_name", "item_category"),
                *_below_one("offered_run_count"),
                *_negative("selected_run_count", "not_selected_run_count", "selected_outcome_run_count",
                           "not_selected_outcome_run_count", "selected_average_kills", "not_selected_average_kills",
                           "selected_average_run_seconds", "not_selected_average_run_seconds"),
                F.col("selected_run_count") + F.col("not_selected_run_count") != F.col("offered_run_count"),
                *_rising("selected_outcome_run_count", "selected_run_count"),
                *_rising("not_selected_outcome_run_count", "not_selected_run_count"),
                *_status("selected_outcome_run_count", "not_selected_outcome_run_count"),
            ],
        ),
        "upgrade_funnel_ranges": (
            "upgrade_funnel",
            [
                *_below_one("exposure_count"),
                *_negative("selection_count"),
                *_rising("selection_count", "exposure_count"),
                *_over_hundred("selection_percentage"),
            ],
        ),
    }


def quality_checks(tables: dict[str, DataFrame], picks: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per check: its name, how many rows fail, and PASS or FAIL.

    `tables` holds the Gold tables by name, `picks` the selections they come from; "run_summary" covers all source types. They are read several times,
    so pass stored tables.
    """
    results = []
    for name, (table, conditions) in row_rules().items():
        broken = reduce(lambda a, b: a | b, conditions)
        results.append(tables[table].where(broken).agg(F.count("*").alias("failed_row_count")).withColumn(
            "check_name", F.lit(name)))
    off = F.abs(F.sum("ended_run_percentage") - 100) > 0.1
    results.append(
        tables["run_outcome"].agg(F.when(off, 1).otherwise(0).cast("bigint").alias("failed_row_count")).withColumn(
            "check_name", F.lit("run_outcome_percentage"))
    )
    results.append(
        uncatalogued_items(picks, catalog).agg(F.count("*").alias("failed_row_count")).withColumn(
            "check_name", F.lit("item_catalog_coverage"))
    )
    status = F.when(F.col("failed_row_count") == 0, "PASS").otherwise("FAIL").alias("check_status")
    return reduce(DataFrame.unionByName, results).select("check_name", "failed_row_count", status)


def require_quality(checks: DataFrame) -> None:
    """Stop the job when any check failed. At most twelve rows reach the driver."""
    failed = [tuple(row) for row in checks.where("check_status <> 'PASS'").collect()]
    if failed:
        raise QualityGateError(f"quality checks failed: {failed}")


class ObservedGate:
    """The twelve checks, counted while the Gold tables are written: no table is read a second time.

    `put` stores a table and notes what its rules find on the way; `results` is known once all tables are stored.
    """

    def __init__(self, write: Callable[[DataFrame, str], DataFrame] = stage):
        self._write = write
        self._found: dict[str, Observation] = {}
        self._rules: dict[str, dict[str, Column]] = {}
        for check, (table, conditions) in row_rules().items():
            broken = F.coalesce(reduce(lambda a, b: a | b, conditions), F.lit(False))
            self._rules.setdefault(table, {})[check] = F.count_if(broken)
        self._rules["run_outcome"] = {"run_outcome_percentage": F.sum("ended_run_percentage")}
        self._rules["picked_items"] = {"item_catalog_coverage": F.count_if(F.col("known").isNull())}

    def put(self, table: str, rows: DataFrame) -> DataFrame:
        if table not in self._rules:
            return self._write(rows, table)
        self._found[table] = Observation()
        return self._write(rows.observe(self._found[table], *[count.alias(check) for check, count in self._rules[table].items()]), table)

    def put_picks(self, picks: DataFrame, catalog: DataFrame) -> DataFrame:
        """The different picked items, each with whether the catalog knows it."""
        known = catalog.select(*ITEM_KEY).withColumn("known", F.lit(True))
        return self.put("picked_items", picks.select(*ITEM_KEY).distinct().join(known, ITEM_KEY, "left"))

    def results(self) -> dict[str, int]:
        """Failed rows by check."""
        missing = sorted(set(self._rules) - set(self._found))
        if missing:
            raise QualityGateError(f"not written yet: {missing}")
        found = {check: value for observation in self._found.values() for check, value in observation.get.items()}
        share = found["run_outcome_percentage"]
        return {**found, "run_outcome_percentage": int(share is not None and abs(share - 100) > 0.1)}

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(check, failed, "FAIL" if failed else "PASS") for check, failed in self.results().items()]
        return spark.createDataFrame(rows, "check_name string, failed_row_count bigint, check_status string")

    def require(self) -> None:
        """Stop the job when any check failed."""
        failed = {check: count for check, count in self.results().items() if count}
        if failed:
            raise QualityGateError(f"quality checks failed: {failed}")
