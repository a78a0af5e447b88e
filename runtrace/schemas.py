"""Stored table layouts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtrace.functions.numeric import bounded

_SIMPLE = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
}


def _columns(text: str) -> T.StructType:
    """A flat layout from `name type, name type`."""
    return T.StructType(
        [T.StructField(name, _SIMPLE[kind]) for name, kind in (part.split() for part in text.split(","))]
    )


SILVER = T.StructType(
    [
        T.StructField(name, kind, nullable=False)
        for name, kind in (
            ("run_id", T.StringType()),
            ("event_id", T.StringType()),
            ("event_name", T.StringType()),
            ("event_sequence", T.LongType()),
            ("run_elapsed_seconds", T.DoubleType()),
            ("source_type", T.StringType()),
            ("game_version", T.StringType()),
            ("schema_version", T.StringType()),
            ("run_status", T.StringType()),
            ("first_received_at", T.TimestampType()),
            ("ingestion_channel", T.StringType()),
            ("event_payload_json", T.StringType()),
            ("quality_issues_json", T.StringType()),
            ("input_event_count", T.LongType()),
            ("unique_event_count", T.LongType()),
            ("exact_retry_count", T.LongType()),
            ("conflicting_duplicate_count", T.LongType()),
        )
    ]
)

#: The issue table: rule columns of one issue; `copies` is how many deliveries have it.
ISSUES = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("path", T.ArrayType(T.StringType())),
        T.StructField("event_id", T.StringType()),
        T.StructField("copies", T.LongType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("event_sequence", T.LongType()),
    ]
)

#: Bronze records that are no deliveries.
REJECTS = T.StructType(
    [
        T.StructField("reason", T.StringType()),
        T.StructField("line_sha256", T.StringType()),
        T.StructField("received_date", T.DateType()),
    ]
)

ITEM_CATALOG = _columns(
    "game_version string, choice_source string, item_id string, display_name string, item_category string, "
    "intended_effect string, primary_metric string, rarity_scaled boolean, metric_readiness string"
)

_COUNT, _MEAN, _MEASURE = "bigint", "decimal(38,2)", "decimal(38,6)"


def _table(*columns: str) -> dict[str, str]:
    """Columns as `name:type`, where n = count, m = two-decimal metric, d = six-decimal measure, s = string."""
    kinds = {"n": _COUNT, "m": _MEAN, "d": _MEASURE, "s": "string", "b": "boolean", "t": "timestamp", "dt": "date"}
    return {name: kinds[kind] for name, kind in (column.split(":") for column in columns)}


GOLD = {
    "run_summary": _table(
        "run_id:s", "received_date:dt", "source_type:s", "game_version:s", "run_status:s", "is_started:b",
        "is_ended:b", "first_received_at:t", "last_received_at:t", "observed_run_seconds:d",
        "run_duration_seconds:d", "max_event_sequence:n", "map_id:s", "starting_weapon_id:s", "starting_max_hp:d",
        "end_reason:s", "final_level:n", "total_kills:n", "total_xp_collected:d", "current_gold:d",
        "total_gold_collected:d", "hearts_collected:n", "total_healing_received:d", "magnets_collected:n",
        "miniboss_waves_reached:n", "miniboss_waves_cleared:n", "final_upgrade_count:n", "final_upgrades_json:s",
        "checkpoint_count:n", "highest_checkpoint_number:n", "upgrade_shown_count:n", "upgrade_selected_count:n",
        "unselected_upgrade_count:n", "input_event_count:n", "unique_event_count:n", "exact_retry_count:n",
        "conflicting_duplicate_count:n", "quality_issue_count:n", "death_cause:s",
    ),
    "run_quality": _table(
        "run_status:s", "run_count:n", "input_event_count:n", "unique_event_count:n", "exact_retry_count:n",
        "conflicting_duplicate_count:n",
    ),
    "run_outcome": _table("end_reason:s", "ended_run_count:n", "ended_run_percentage:m", "average_run_seconds:m"),
    "checkpoint_metrics": _table(
        "checkpoint_number:n", "checkpoint_event_count:n", "average_player_level:m", "average_current_xp:m",
        "average_xp_to_next_level:m", "average_hp_percent:m", "average_total_kills:m", "average_current_gold:m",
    ),
    "run_progression": _table(
        "game_version:s", "checkpoint_number:n", "elapsed_minutes:n", "started_run_count:n", "reached_run_count:n",
        "reach_percentage:m", "previous_reached_run_count:n", "step_dropoff_percentage:m",
    ),
    "upgrade_post_selection": _table(
        "game_version:s", "choice_source:s", "item_id:s", "rarity:s", "selection_minute:n", "selection_count:n",
        "selected_run_count:n", "outcome_observed_run_count:n", "average_seconds_after_selection:m",
        "death_within_60_seconds_count:n", "death_within_60_seconds_percentage:m", "average_final_level:m",
        "average_total_kills:m", "analysis_status:s",
    ),
    "item_performance_summary": _table(
        "game_version:s", "choice_source:s", "item_id:s", "display_name:s", "item_category:s", "intended_effect:s",
        "primary_metric:s", "rarity_scaled:b", "metric_readiness:s", "selection_count:n", "selected_run_count:n",
        "outcome_observed_run_count:n", "average_seconds_after_selection:m", "death_within_60_seconds_count:n",
        "death_within_60_seconds_percentage:m", "average_final_level:m", "average_total_kills:m", "analysis_status:s",
    ),
    "weapon_popularity": _table(
        "game_version:s", "weapon_id:s", "display_name:s", "starting_run_count:n", "exposure_count:n",
        "exposed_run_count:n", "selection_count:n", "selected_run_count:n", "first_selected_run_count:n",
        "selection_percentage:m",
    ),
    "weapon_performance": _table(
        "game_version:s", "weapon_id:s", "display_name:s", "run_count:n", "outcome_observed_run_count:n",
        "average_run_seconds:m", "average_total_kills:m", "kills_per_minute:m", "average_final_level:m",
        "average_total_xp:m", "average_total_gold:m", "death_percentage:m", "analysis_status:s",
    ),
    "option_outcome_comparison": _table(
        "game_version:s", "choice_source:s", "item_id:s", "display_name:s", "item_category:s", "offered_run_count:n",
        "selected_run_count:n", "not_selected_run_count:n", "selected_outcome_run_count:n",
        "not_selected_outcome_run_count:n", "selected_average_kills:m", "not_selected_average_kills:m",
        "average_kill_difference:m", "selected_average_run_seconds:m", "not_selected_average_run_seconds:m",
        "average_run_seconds_difference:m", "analysis_status:s",
    ),
    "upgrade_funnel": _table(
        "choice_source:s", "item_id:s", "rarity:s", "exposure_count:n", "selection_count:n", "selection_percentage:m",
    ),
}


def gold_columns(table: str) -> list[Column]:
    """The named, typed projection that a Gold table is stored with."""
    return [_as_stored(F.col(name), kind).alias(name) for name, kind in GOLD[table].items()]


def _as_stored(value: Column, kind: str) -> Column:
    """A value in its published type; an amount beyond a decimal type is given as the type's largest number."""
    if not kind.startswith("decimal"):
        return value.cast(kind)
    digits, scale = (int(n) for n in kind[8:-1].split(","))
    return bounded(value, kind, Decimal("9" * (digits - scale) + "." + "9" * scale))


_EXPORT_ARRAYS = {
    "event_counts": "event_name string, count bigint",
    "upgrade_option_counts": "item_id string, rarity string, slot int, shown_count bigint",
    "upgrade_selected_counts": "item_id string, rarity string, slot int, selected_count bigint",
    "run_checkpoint_counts": (
        "checkpoint_number int, checkpoint_count bigint, player_level_sum bigint, current_xp_sum double, "
        "xp_to_next_level_sum double, hp_percent_sum double, total_kills_sum bigint, current_gold_sum double"
    ),
    "run_end_counts": (
        "end_reason string, end_count bigint, run_duration_seconds_sum double, final_level_sum bigint, "
        "total_kills_sum bigint, current_gold_sum double"
    ),
}
EXPORT_METRICS = {name: _columns(ddl) for name, ddl in _EXPORT_ARRAYS.items()}
EXPORT_HEADER = ("schema_version", "bucket_date", "revision", "source_region", "destination_region",
                 "privacy_mode", "data_class")
EXPORT = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("bucket_date", T.StringType()),
        T.StructField("revision", T.LongType()),
        T.StructField("source_region", T.StringType()),
        T.StructField("destination_region", T.StringType()),
        T.StructField("privacy_mode", T.StringType()),
        T.StructField("data_class", T.StringType()),
        T.StructField(
            "metrics",
            T.StructType([T.StructField(name, T.ArrayType(item)) for name, item in EXPORT_METRICS.items()]),
        ),
    ]
)
