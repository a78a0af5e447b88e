"""Tables that grow with the runs are never broadcast in the Gold joins, however small they look when packed."""

from __future__ import annotations

from pyspark.sql import functions as F

from runtrace.operators import gold_items


def _plan(rows):
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString()


def test_runs_and_picks_are_not_broadcast(spark):
    numbers = spark.range(200).select(F.col("id").cast("string").alias("run_id"), F.lit("1.0").alias("game_version"), F.col("id"))
    picks = numbers.select("run_id", "game_version", F.col("id").alias("event_sequence"), F.lit(1.5).alias("run_elapsed_seconds"),
                           F.lit("c").alias("choice_id"), F.lit("statue").alias("choice_source"), F.lit("i").alias("item_id"), F.lit("rare").alias("rarity"))
    offers = picks.select("run_id", "game_version", "choice_id", "choice_source", "item_id", "rarity")
    runs = numbers.select("run_id", F.lit(True).alias("is_ended"), F.lit("quit").alias("end_reason"), F.lit(3).cast("bigint").alias("final_level"),
                          F.lit(7).cast("bigint").alias("total_kills"), F.lit(60.0).alias("run_duration_seconds"))
    after = gold_items.upgrade_post_selection(picks, runs)
    funnel = gold_items.upgrade_funnel(offers, picks)
    assert "Broadcast" not in _plan(after) + _plan(funnel)
    assert after.first()["selected_run_count"] == 200 and funnel.first()["selection_count"] == 200
