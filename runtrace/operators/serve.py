"""Dashboard queries over stored Gold tables, with an optional game version."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtrace.functions.numeric import cents, mean, percentage
from runtrace.labels import COLUMN_LABELS, VALUE_LABELS


def of_version(rows: DataFrame, game_version: str | None) -> DataFrame:
    """Rows of one version, or all; the version is compared as a value and never becomes SQL text."""
    if game_version is None:
        return rows
    if not re.fullmatch(r"[A-Za-z0-9._+-]{1,32}", game_version):
        raise ValueError("game_version has an unexpected form")
    return rows.where(F.col("game_version") == F.lit(game_version))


def run_overview(runs: DataFrame, game_version: str | None = None) -> DataFrame:
    """Totals with the shares of ended and incomplete runs and the mean duration in minutes."""
    ended, total = F.count_if("is_ended"), F.count("*")
    seconds = mean(F.col("run_duration_seconds"))
    return of_version(runs, game_version).agg(
        total.alias("total_run_count"),
        F.count_if("is_started").alias("started_run_count"),
        ended.alias("ended_run_count"),
        F.count_if(~F.col("is_ended")).alias("incomplete_run_count"),
        seconds.alias("average_run_seconds"),
        percentage(ended, total).alias("ended_percentage"),
        percentage(F.count_if(~F.col("is_ended")), total).alias("incomplete_percentage"),
        cents(seconds, F.lit(60)).alias("average_run_minutes"),
    )


def run_endings(runs: DataFrame, game_version: str | None = None) -> DataFrame:
    """Runs by ending and cause; unfinished runs, deaths without a cause and other endings have their own labels."""
    death = F.coalesce(F.col("end_reason") == "player_death", F.lit(False))
    cause = F.when(death, F.coalesce("death_cause", F.lit("not_collected_legacy"))).otherwise("not_applicable")
    reason = F.coalesce("end_reason", F.lit("incomplete"))
    return (
        of_version(runs, game_version)
        .groupBy(reason.alias("end_reason"), cause.alias("death_cause"))
        .agg(F.count("*").alias("run_count"), mean(F.col("run_duration_seconds")).alias("average_run_seconds"))
        .orderBy(F.desc("run_count"), "end_reason", "death_cause")
    )


def death_causes(runs: DataFrame, game_version: str | None = None) -> DataFrame:
    """How deaths are spread over their causes."""
    return (
        run_endings(runs, game_version)
        .where("end_reason = 'player_death'")
        .groupBy("death_cause")
        .agg(F.sum("run_count").alias("run_count"))
    )


# Table -> (columns shown, order). Descending orders put NULL last, ascending ones too.
_LISTINGS = {
    "run_progression": (
        ["game_version", "checkpoint_number", "elapsed_minutes", "started_run_count", "reached_run_count",
         "reach_percentage", "step_dropoff_percentage"],
        ["game_version", "checkpoint_number"],
    ),
    "item_performance_summary": (
        ["game_version", "choice_source", "item_id", "display_name", "item_category", "intended_effect",
         "primary_metric", "selection_count", "selected_run_count", "outcome_observed_run_count",
         "average_seconds_after_selection", "death_within_60_seconds_percentage", "average_final_level",
         "average_total_kills", "analysis_status"],
        ["-outcome_observed_run_count", "display_name"],
    ),
    "weapon_popularity": (
        ["game_version", "weapon_id", "display_name", "starting_run_count", "exposure_count", "exposed_run_count",
         "selection_count", "selected_run_count", "first_selected_run_count", "selection_percentage"],
        ["-first_selected_run_count", "-selection_percentage"],
    ),
    "weapon_performance": (
        ["game_version", "weapon_id", "display_name", "run_count", "outcome_observed_run_count",
         "average_run_seconds", "average_total_kills", "kills_per_minute", "average_final_level",
         "average_total_xp", "average_total_gold", "death_percentage", "analysis_status"],
        ["-average_total_kills", "-outcome_observed_run_count"],
    ),
    "option_outcome_comparison": (
        ["game_version", "choice_source", "item_id", "display_name", "item_category", "offered_run_count",
         "selected_run_count", "not_selected_run_count", "selected_outcome_run_count",
         "not_selected_outcome_run_count", "selected_average_kills", "not_selected_average_kills",
         "average_kill_difference", "selected_average_run_seconds", "not_selected_average_run_seconds",
         "average_run_seconds_difference", "analysis_status"],
        ["-average_kill_difference", "-offered_run_count"],
    ),
    "run_quality": (
        ["run_status", "run_count", "input_event_count", "unique_event_count", "exact_retry_count",
         "conflicting_duplicate_count"],
        ["-run_count", "run_status"],
    ),
}


def listing(table: str, rows: DataFrame, game_version: str | None = None) -> DataFrame:
    """A Gold table as the dashboard shows it: chosen columns in a fixed order of rows."""
    columns, order = _LISTINGS[table]
    if table != "run_quality":
        rows = of_version(rows, game_version)
    keys = [F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in order]
    return rows.select(*columns).orderBy(*keys)


def versions(runs: DataFrame) -> DataFrame:
    return runs.select("game_version").where("game_version IS NOT NULL").distinct().orderBy("game_version")


def relabelled(rows: DataFrame) -> DataFrame:
    """Display names for known columns and values; whatever is unknown stays as it is."""
    labels = F.create_map(*[F.lit(part) for pair in VALUE_LABELS.items() for part in pair])

    def shown(name: str, kind: str):
        column = F.col(name)
        if kind == "string":
            column = F.coalesce(F.try_element_at(labels, column), column)
        return column.alias(COLUMN_LABELS.get(name, name))

    return rows.select(*[shown(name, kind) for name, kind in rows.dtypes])
