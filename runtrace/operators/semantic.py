"""Governed metrics: named aggregates over named dimensions, and nothing else."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace.functions.numeric import exact, ratio

RESULT_LIMIT = 20


@dataclass(frozen=True)
class MetricView:
    """Dimensions map public names to columns; metrics map public names to aggregates.

    Source columns and identifiers that are not listed cannot be reached through it.
    """

    dimensions: dict[str, str]
    metrics: dict[str, Column]

    def query(self, table: DataFrame, dimensions: Sequence[str], metrics: Sequence[str]) -> DataFrame:
        unknown = [d for d in dimensions if d not in self.dimensions] + [m for m in metrics if m not in self.metrics]
        if unknown:
            raise ValueError(f"not a dimension or metric: {', '.join(unknown)}")
        if not metrics:
            raise ValueError("a query needs at least one metric")
        keys = [F.col(self.dimensions[name]).alias(name) for name in dimensions]
        return table.groupBy(*keys).agg(*[self.metrics[name].alias(name) for name in metrics])


def runs_view() -> MetricView:
    """Over the product run summary."""
    kills, seconds = F.col("total_kills"), F.col("run_duration_seconds")
    return MetricView(
        {
            "game_version": "game_version",
            "received_date": "received_date",
            "starting_weapon": "starting_weapon_id",
            "run_status": "run_status",
            "end_reason": "end_reason",
            "death_cause": "death_cause",
        },
        {
            "run_count": F.count("run_id"),
            "started_run_count": F.count_if("is_started"),
            "ended_run_count": F.count_if("is_ended"),
            "incomplete_run_count": F.count_if(~F.col("is_ended")),
            "average_kill_count": ratio(F.sum(kills), F.count(kills)),
            "total_kill_count": F.sum(kills),
            "average_run_seconds": ratio(F.sum(exact(seconds)), F.count(seconds)),
            "kills_per_minute": ratio(F.sum(kills) * F.lit(60), F.sum(exact(seconds))),
            "death_percentage": ratio(
                F.count_if(F.col("end_reason") == "player_death") * F.lit(100), F.count_if("is_ended")
            ),
        },
    )


def weapon_popularity_view() -> MetricView:
    return MetricView(
        {"game_version": "game_version", "weapon_id": "weapon_id", "weapon_name": "display_name"},
        {
            "starting_run_count": F.sum("starting_run_count"),
            "exposure_count": F.sum("exposure_count"),
            "selection_count": F.sum("selection_count"),
            "first_selected_run_count": F.sum("first_selected_run_count"),
            "exposure_adjusted_selection_percentage": ratio(
                F.sum("selection_count") * F.lit(100), F.sum("exposure_count")
            ),
        },
    )


def weapon_performance_view() -> MetricView:
    return MetricView(
        {
            "game_version": "game_version",
            "weapon_id": "weapon_id",
            "weapon_name": "display_name",
            "sample_status": "analysis_status",
        },
        {
            "observed_run_count": F.sum("outcome_observed_run_count"),
            "average_kill_count": F.max("average_total_kills"),
            "kills_per_minute": F.max("kills_per_minute"),
            "average_survival_seconds": F.max("average_run_seconds"),
            "death_percentage": F.max("death_percentage"),
        },
    )


def option_outcomes_view() -> MetricView:
    return MetricView(
        {
            "game_version": "game_version",
            "choice_source": "choice_source",
            "item_id": "item_id",
            "item_name": "display_name",
            "item_category": "item_category",
            "sample_status": "analysis_status",
        },
        {
            "offered_run_count": F.sum("offered_run_count"),
            "selected_run_count": F.sum("selected_run_count"),
            "not_selected_run_count": F.sum("not_selected_run_count"),
            "selected_average_kills": F.max("selected_average_kills"),
            "not_selected_average_kills": F.max("not_selected_average_kills"),
            "average_kill_difference": F.max("average_kill_difference"),
            "average_survival_seconds_difference": F.max("average_run_seconds_difference"),
        },
    )


def _top(rows: DataFrame, metric: str, dimensions: Sequence[str]) -> DataFrame:
    """The first rows by a metric, NULL last; equal metrics are ordered by the dimensions."""
    return rows.orderBy(F.desc_nulls_last(metric), *dimensions).limit(RESULT_LIMIT)


def most_first_selected_weapons(weapon_popularity: DataFrame) -> DataFrame:
    dimensions = ["game_version", "weapon_name"]
    metrics = ["first_selected_run_count", "exposure_count", "exposure_adjusted_selection_percentage"]
    return _top(weapon_popularity_view().query(weapon_popularity, dimensions, metrics), metrics[0], dimensions)


def highest_kill_starting_weapons(weapon_performance: DataFrame) -> DataFrame:
    dimensions = ["game_version", "weapon_name", "sample_status"]
    metrics = ["observed_run_count", "average_kill_count", "kills_per_minute"]
    return _top(weapon_performance_view().query(weapon_performance, dimensions, metrics), metrics[1], dimensions)


def longer_survival_options(option_outcomes: DataFrame) -> DataFrame:
    dimensions = ["game_version", "choice_source", "item_name", "item_category", "sample_status"]
    metrics = ["offered_run_count", "selected_run_count", "not_selected_run_count",
               "average_survival_seconds_difference"]
    return _top(option_outcomes_view().query(option_outcomes, dimensions, metrics), metrics[-1], dimensions)
