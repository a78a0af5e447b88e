"""Run-level Gold tables: one row per run, and its roll-ups by status, outcome and checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.functions.numeric import mean, percentage
from runtrace.functions.payload import field, product_events

_START_FIELDS = {"map_id": "string", "starting_weapon_id": "string", "starting_max_hp": "double"}
_END_FIELDS = {
    "end_reason": "string",
    "death_cause": "string",
    "final_level": "bigint",
    "total_kills": "bigint",
    "total_xp_collected": "double",
    "current_gold": "double",
    "total_gold_collected": "double",
    "hearts_collected": "bigint",
    "total_healing_received": "double",
    "magnets_collected": "bigint",
    "miniboss_waves_reached": "bigint",
    "miniboss_waves_cleared": "bigint",
}
_MEMBERS = {**_START_FIELDS, **_END_FIELDS, "checkpoint_number": "bigint", "final_upgrades": "variant"}


def _named(name: str) -> Column:
    return F.col("event_name") == name


def _issue_count(silver: DataFrame) -> Column:
    """Rows written by this library store the count; rows from elsewhere are counted from their issue list."""
    if "quality_issue_count" in silver.columns:
        return F.col("quality_issue_count")
    return F.coalesce(F.json_array_length("quality_issues_json"), F.lit(0)).cast("bigint")


def run_summary(silver: DataFrame) -> DataFrame:
    """One row per run over all source types, in one aggregation by run with partial results before the shuffle."""
    start, end = _named("run_started"), _named("run_ended")
    checkpoint = _named("run_checkpoint")
    shown, selected = _named("upgrade_options_shown"), _named("upgrade_selected")
    parsed = F.when(start | end | checkpoint, F.try_parse_json("event_payload_json"))
    layout = ",".join(f"{name}:{kind}" for name, kind in _MEMBERS.items())
    events = silver.select("*", parsed.alias("p"), _issue_count(silver).alias("issue_count"))
    events = events.select("*", F.try_variant_get("p", F.lit("$"), f"struct<{layout}>").alias("m"))
    listed = F.col("m")["final_upgrades"]
    upgrades = F.try_variant_get(listed, F.lit("$"), "array<variant>")

    def at(condition: Column, value: Column) -> Column:
        return F.max(F.when(condition, value))

    shown_count, selected_count = F.count_if(shown), F.count_if(selected)
    return events.groupBy("run_id").agg(
        F.min("received_date").alias("received_date"),
        F.max("source_type").alias("source_type"),
        F.max("game_version").alias("game_version"),
        F.max("run_status").alias("run_status"),
        (F.count_if(start) > 0).alias("is_started"),
        (F.count_if(end) > 0).alias("is_ended"),
        F.min("first_received_at").alias("first_received_at"),
        F.max("first_received_at").alias("last_received_at"),
        F.max("run_elapsed_seconds").alias("observed_run_seconds"),
        at(end, F.col("run_elapsed_seconds")).alias("run_duration_seconds"),
        F.max("event_sequence").alias("max_event_sequence"),
        *[at(start, F.col("m")[name]).alias(name) for name in _START_FIELDS],
        *[at(end, F.col("m")[name]).alias(name) for name in _END_FIELDS],
        at(end, F.size(upgrades).cast("bigint")).alias("final_upgrade_count"),
        at(end, F.to_json(listed)).alias("final_upgrades_json"),
        F.count_if(checkpoint).alias("checkpoint_count"),
        at(checkpoint, F.col("m")["checkpoint_number"]).alias("highest_checkpoint_number"),
        shown_count.alias("upgrade_shown_count"),
        selected_count.alias("upgrade_selected_count"),
        F.greatest(shown_count - selected_count, F.lit(0)).cast("bigint").alias("unselected_upgrade_count"),
        F.max("input_event_count").alias("input_event_count"),
        F.max("unique_event_count").alias("unique_event_count"),
        F.max("exact_retry_count").alias("exact_retry_count"),
        F.max("conflicting_duplicate_count").alias("conflicting_duplicate_count"),
        F.max("issue_count").alias("quality_issue_count"),
    )


def product_run_summary(silver: DataFrame) -> DataFrame:
    """Run summary of consented play only.

    The source type belongs to the run, so the filter may stand below the aggregation and reach the scan.
    """
    return run_summary(silver.where(F.col("source_type") == contract.PRODUCT_SOURCE))


def run_quality(silver: DataFrame) -> DataFrame:
    """Runs and their delivery counters by status; the run's last event speaks for the run."""
    counters = ["input_event_count", "unique_event_count", "exact_retry_count", "conflicting_duplicate_count"]
    last = F.max(F.struct("event_sequence", "run_status", *counters)).alias("last")
    runs = silver.groupBy("run_id").agg(last).select("last.*")
    return runs.groupBy("run_status").agg(
        F.count("*").alias("run_count"), *[F.sum(name).alias(name) for name in counters]
    )


def run_outcome(silver: DataFrame) -> DataFrame:
    """Ended product runs by end reason with their share; the window sees one row per end reason."""
    ended = product_events(silver, "run_ended", "run_elapsed_seconds").select(
        "run_elapsed_seconds", field(F.col("p"), "end_reason").alias("end_reason")
    )
    grouped = ended.groupBy("end_reason").agg(
        F.count("*").alias("ended_run_count"), mean(F.col("run_elapsed_seconds")).alias("average_run_seconds")
    )
    total = F.sum("ended_run_count").over(Window.partitionBy())
    return grouped.select(
        "end_reason",
        "ended_run_count",
        percentage(F.col("ended_run_count"), total).alias("ended_run_percentage"),
        "average_run_seconds",
    )


def checkpoint_metrics(silver: DataFrame) -> DataFrame:
    measures = {
        "player_level": "bigint",
        "current_xp": "double",
        "xp_to_next_level": "double",
        "hp_percent": "double",
        "total_kills": "bigint",
        "current_gold": "double",
    }
    rows = product_events(silver, "run_checkpoint").select(
        field(F.col("p"), "checkpoint_number", "bigint").alias("checkpoint_number"),
        *[field(F.col("p"), name, kind).alias(name) for name, kind in measures.items()],
    )
    return rows.groupBy("checkpoint_number").agg(
        F.count("*").alias("checkpoint_event_count"),
        *[mean(F.col(name)).alias(f"average_{name}") for name in measures],
    )
