"""How far started runs get, by version and checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runtrace.functions.numeric import percentage

_STEP = 10_000


def progression_histogram(product_runs: DataFrame, *keys: str) -> DataFrame:
    """Started runs by version and highest checkpoint (and more keys): counts that may be added up."""
    highest = F.greatest(F.coalesce("highest_checkpoint_number", F.lit(0)), F.lit(0))
    started = product_runs.where("is_started AND game_version IS NOT NULL")
    return started.groupBy(*keys, "game_version", highest.alias("highest")).agg(F.count("*").alias("runs"))


def run_progression(product_runs: DataFrame) -> DataFrame:
    """Reach and drop-off for every checkpoint 1..max of each version."""
    return progression_of(progression_histogram(product_runs))


def progression_of(histogram: DataFrame) -> DataFrame:
    """The same from the histogram of runs by (version, highest checkpoint).

    That is all the windows see: a running
    total from the top gives the runs that reach each of its steps, and the numbers between two steps share the
    upper step's count, so no run is ever joined to a list of checkpoints.
    """
    version = Window.partitionBy("game_version")
    from_top = version.orderBy(F.desc("highest")).rowsBetween(Window.unboundedPreceding, 0)
    steps = histogram.select(
        "game_version",
        "highest",
        F.sum("runs").over(version).alias("started_run_count"),
        F.sum("runs").over(from_top).alias("reached_run_count"),
        F.coalesce(F.lag("highest").over(version.orderBy("highest")), F.lit(0)).alias("below"),
    ).where("highest > 0")
    ascending = version.orderBy("highest")
    steps = steps.withColumn(
        "reached_below", F.coalesce(F.lag("reached_run_count").over(ascending), F.col("started_run_count"))
    )
    # Two short sequences instead of one long one keep every array small, however high a checkpoint number is.
    blocks = F.explode(F.sequence(F.floor(F.col("below") / _STEP), F.floor((F.col("highest") - 1) / _STEP)))
    first = F.greatest(F.col("below"), F.col("block") * _STEP) + 1
    last = F.least(F.col("highest"), (F.col("block") + 1) * _STEP)
    numbered = steps.select("*", blocks.alias("block")).select(
        "*", F.explode(F.sequence(first, last)).alias("checkpoint_number")
    )
    previous = F.when(F.col("checkpoint_number") == F.col("below") + 1, F.col("reached_below")).otherwise(
        F.col("reached_run_count")
    )
    return numbered.select(
        "game_version",
        "checkpoint_number",
        F.col("checkpoint_number").alias("elapsed_minutes"),
        "started_run_count",
        "reached_run_count",
        percentage(F.col("reached_run_count"), F.col("started_run_count")).alias("reach_percentage"),
        previous.alias("previous_reached_run_count"),
        percentage(previous - F.col("reached_run_count"), previous).alias("step_dropoff_percentage"),
    )
