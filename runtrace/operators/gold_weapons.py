"""Weapon popularity and the outcomes of runs by starting weapon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtrace.functions.numeric import cents, exact, mean, percentage
from runtrace.operators.gold_items import sample_status

_WEAPON_CHOICE = "level_up_weapon"


def weapon_popularity(
    offers: DataFrame, picks: DataFrame, product_runs: DataFrame, catalog: DataFrame
) -> DataFrame:
    """Every catalog weapon with its starts, exposures and picks; weapons nobody met count 0.

    Events are counted per run and weapon first, so distinct runs and first picks come from rows that are
    already combined.
    """
    key = ["game_version", "item_id"]
    weapon_choice = F.col("choice_source") == _WEAPON_CHOICE
    starts = (
        product_runs.where("is_started AND starting_weapon_id IS NOT NULL")
        .groupBy("game_version", F.col("starting_weapon_id").alias("item_id"))
        .agg(F.count("*").alias("starting_run_count"))
    )
    offered = (
        offers.where(weapon_choice)
        .groupBy("run_id", *key)
        .agg(F.count("*").alias("offers"))
        .groupBy(*key)
        .agg(F.sum("offers").alias("exposure_count"), F.count("*").alias("exposed_run_count"))
    )
    per_run = (
        picks.where(weapon_choice)
        .groupBy("run_id", *key)
        .agg(F.count("*").alias("picks"), F.min("event_sequence").alias("event_sequence"))
    )
    picked = per_run.groupBy(*key).agg(
        F.sum("picks").alias("selection_count"), F.count("*").alias("selected_run_count")
    )
    first = (
        per_run.groupBy("run_id")
        .agg(F.min(F.struct("event_sequence", *key)).alias("first"))
        .groupBy("first.game_version", "first.item_id")
        .agg(F.count("*").alias("first_selected_run_count"))
    )
    weapons = catalog.where("item_category = 'weapon'").select(*key, "display_name")
    joined = weapons
    for side in (starts, offered, picked, first):
        joined = joined.join(side, key, "left")
    counts = ["starting_run_count", "exposure_count", "exposed_run_count", "selection_count", "selected_run_count",
              "first_selected_run_count"]
    return joined.select(
        "game_version",
        F.col("item_id").alias("weapon_id"),
        "display_name",
        *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in counts],
        percentage(F.coalesce("selection_count", F.lit(0)), F.col("exposure_count")).alias("selection_percentage"),
    )


def weapon_performance(product_runs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Outcomes by starting weapon; runs are aggregated before the catalog names are joined."""
    ended = F.col("is_ended")
    observed = F.count_if(ended)
    kills, seconds = F.when(ended, F.col("total_kills")), F.when(ended, F.col("run_duration_seconds"))
    by_weapon = (
        product_runs.where("is_started AND starting_weapon_id IS NOT NULL")
        .groupBy("game_version", F.col("starting_weapon_id").alias("weapon_id"))
        .agg(
            F.count("*").alias("run_count"),
            observed.alias("outcome_observed_run_count"),
            mean(seconds).alias("average_run_seconds"),
            mean(kills).alias("average_total_kills"),
            cents(F.sum(kills) * F.lit(60), F.sum(exact(seconds))).alias("kills_per_minute"),
            mean(F.when(ended, F.col("final_level"))).alias("average_final_level"),
            mean(F.when(ended, F.col("total_xp_collected"))).alias("average_total_xp"),
            mean(F.when(ended, F.col("total_gold_collected"))).alias("average_total_gold"),
            percentage(F.count_if(ended & (F.col("end_reason") == "player_death")), observed).alias(
                "death_percentage"
            ),
            sample_status(observed).alias("analysis_status"),
        )
    )
    names = catalog.where(F.col("choice_source") == _WEAPON_CHOICE).select(
        "game_version", F.col("item_id").alias("weapon_id"), "display_name"
    )
    measures = [name for name in by_weapon.columns if name not in ("game_version", "weapon_id")]
    return by_weapon.join(names, ["game_version", "weapon_id"], "left").select(
        "game_version", "weapon_id", "display_name", *measures
    )
