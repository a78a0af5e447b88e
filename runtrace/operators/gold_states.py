"""Gold refreshed by date: states that add up.

A run belongs to one date, so counts, sums, counts of different runs and histograms of one date's runs may be added to those of the
others. A state is a small table of such columns by the keys of a Gold table and by date. When some dates change, only their
Silver rows are read and only their states replaced; Gold is the sum of all states, finished by the same exact rounding as a
full refresh.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.functions.numeric import cents, exact, mean_of, mean_parts, percentage
from runtrace.functions.payload import field
from runtrace.operators.gold_items import ITEM_KEY, exposures, first_picks, item_performance_summary, sample_status, selections
from runtrace.operators.gold_progression import progression_histogram, progression_of
from runtrace.operators.gold_runs import product_events, run_summary
from runtrace.sources.staging import exists, remove, stage

DAY = "received_date"
_COUNTERS = ["input_event_count", "unique_event_count", "exact_retry_count", "conflicting_duplicate_count"]
_CHECKPOINT = {"player_level": "bigint", "current_xp": "double", "xp_to_next_level": "double", "hp_percent": "double",
               "total_kills": "bigint", "current_gold": "double"}
_PICK_KEY = [*ITEM_KEY, "rarity", "selection_minute"]
_WEAPON_COUNTS = ["starting_run_count", "exposure_count", "exposed_run_count", "selection_count", "selected_run_count", "first_selected_run_count"]
_WEAPON_MEANS = {"average_run_seconds": "run_duration_seconds", "average_total_kills": "total_kills", "average_final_level": "final_level",
                 "average_total_xp": "total_xp_collected", "average_total_gold": "total_gold_collected"}
_ARMS = ("selected", "not_selected")
_WEAPON_CHOICE = "level_up_weapon"

#: The keys of each state.
KEYS = {
    "run_quality": ["run_status"],
    "run_outcome": ["end_reason"],
    "checkpoint_metrics": ["checkpoint_number"],
    "run_progression": ["game_version", "highest"],
    "upgrade_post_selection": _PICK_KEY,
    "weapon_popularity": ["game_version", "item_id"],
    "weapon_performance": ["game_version", "weapon_id"],
    "option_outcome_comparison": ITEM_KEY,
    "upgrade_funnel": ["choice_source", "item_id", "rarity"],
}


def _quality(silver: DataFrame) -> DataFrame:
    last = F.max(F.struct("event_sequence", "run_status", *_COUNTERS)).alias("last")
    runs = silver.groupBy(DAY, "run_id").agg(last).select(DAY, "last.*")
    return runs.groupBy(DAY, "run_status").agg(F.count("*").alias("run_count"), *[F.sum(c).alias(c) for c in _COUNTERS])


def _outcome(silver: DataFrame) -> DataFrame:
    ended = product_events(silver, "run_ended", DAY, "run_elapsed_seconds").withColumn("end_reason", field(F.col("p"), "end_reason"))
    return ended.groupBy(DAY, "end_reason").agg(F.count("*").alias("ended_run_count"), *mean_parts(F.col("run_elapsed_seconds"), "average_run_seconds"))


def _checkpoints(silver: DataFrame) -> DataFrame:
    rows = product_events(silver, "run_checkpoint", DAY).select(
        DAY, field(F.col("p"), "checkpoint_number", "bigint").alias("checkpoint_number"),
        *[field(F.col("p"), name, kind).alias(name) for name, kind in _CHECKPOINT.items()])
    parts = [part for name in _CHECKPOINT for part in mean_parts(F.col(name), f"average_{name}")]
    return rows.groupBy(DAY, "checkpoint_number").agg(F.count("*").alias("checkpoint_event_count"), *parts)


def _after_pick(picks: DataFrame, runs: DataFrame) -> DataFrame:
    ended = F.col("is_ended")
    left = F.greatest(exact(F.col("run_duration_seconds")) - exact(F.col("first_selected_at_seconds")), exact(F.lit(0)))
    columns = ["run_id", DAY, "is_ended", "end_reason", "final_level", "total_kills", "run_duration_seconds"]
    judged = first_picks(picks).join(runs.select(*columns), "run_id")
    judged = judged.withColumn("remaining", F.when(ended & F.col("run_duration_seconds").isNotNull(), left))
    soon = ended & (F.col("end_reason") == "player_death") & (F.col("remaining") <= 60)
    return judged.groupBy(DAY, *_PICK_KEY).agg(
        F.sum("selection_count_in_run").alias("selection_count"), F.count("*").alias("selected_run_count"),
        F.count_if(ended).alias("outcome_observed_run_count"), F.count_if(soon).alias("death_within_60_seconds_count"),
        *mean_parts(F.col("remaining"), "average_seconds_after_selection"),
        *mean_parts(F.when(ended, F.col("final_level")), "average_final_level"),
        *mean_parts(F.when(ended, F.col("total_kills")), "average_total_kills"))


def _popularity(offers: DataFrame, picks: DataFrame, runs: DataFrame) -> DataFrame:
    """Four kinds of rows, each with its own counts, added up at once."""
    key, weapon = [DAY, "game_version", "item_id"], F.col("choice_source") == _WEAPON_CHOICE
    day = runs.select("run_id", DAY)

    def counts(rows: DataFrame, **own: Column) -> DataFrame:
        return rows.select(*key, *[own.get(name, F.lit(0)).cast("bigint").alias(name) for name in _WEAPON_COUNTS])

    one = F.lit(1)
    starts = runs.where("is_started AND starting_weapon_id IS NOT NULL").withColumn("item_id", F.col("starting_weapon_id"))
    offered = offers.where(weapon).groupBy("run_id", "game_version", "item_id").agg(F.count("*").alias("n")).join(day, "run_id")
    taken = picks.where(weapon).groupBy("run_id", "game_version", "item_id").agg(F.count("*").alias("n"), F.min("event_sequence").alias("at")).join(day, "run_id")
    first = taken.groupBy("run_id", DAY).agg(F.min(F.struct("at", "game_version", "item_id")).alias("f")).select(DAY, "f.game_version", "f.item_id")
    rows = counts(starts, starting_run_count=one)
    for part in (counts(offered, exposure_count=F.col("n"), exposed_run_count=one), counts(taken, selection_count=F.col("n"), selected_run_count=one),
                 counts(first, first_selected_run_count=one)):
        rows = rows.unionByName(part)
    return rows.groupBy(*key).agg(*[F.sum(name).alias(name) for name in _WEAPON_COUNTS])


def _performance(runs: DataFrame) -> DataFrame:
    ended = F.col("is_ended")
    of = lambda name: F.when(ended, F.col(name))
    started = runs.where("is_started AND starting_weapon_id IS NOT NULL").withColumn("weapon_id", F.col("starting_weapon_id"))
    return started.groupBy(DAY, "game_version", "weapon_id").agg(
        F.count("*").alias("run_count"), F.count_if(ended).alias("outcome_observed_run_count"),
        F.count_if(ended & (F.col("end_reason") == "player_death")).alias("deaths"),
        F.sum(of("total_kills")).alias("kills"), F.sum(exact(of("run_duration_seconds"))).alias("seconds"),
        *[part for name, source in _WEAPON_MEANS.items() for part in mean_parts(of(source), name)])


def _options(offers: DataFrame, picks: DataFrame, runs: DataFrame) -> DataFrame:
    picked = picks.select("run_id", "choice_source", "item_id").distinct().withColumn("picked", F.lit(True))
    outcomes = runs.select("run_id", DAY, "is_ended", "run_duration_seconds", "total_kills")
    seen = offers.select("run_id", *ITEM_KEY).distinct().join(outcomes, "run_id").join(picked, ["run_id", "choice_source", "item_id"], "left")
    chosen = F.coalesce("picked", F.lit(False))
    parts = [F.count("*").alias("offered_run_count")]
    for arm, inside in zip(_ARMS, (chosen, ~chosen)):
        counted = inside & F.col("is_ended")
        parts += [F.count_if(inside).alias(f"{arm}_run_count"), F.count_if(counted).alias(f"{arm}_outcome_run_count")]
        for name in ("total_kills", "run_duration_seconds"):
            value = F.when(counted, F.col(name))
            parts += [F.sum(exact(value)).alias(f"{arm}_{name}__sum"), F.count(value).alias(f"{arm}_{name}__n")]
    return seen.groupBy(DAY, *ITEM_KEY).agg(*parts)


def _funnel(offers: DataFrame, picks: DataFrame, runs: DataFrame) -> DataFrame:
    key = ["run_id", "choice_id", "item_id"]
    offered = offers.groupBy(*key, "choice_source", "rarity").agg(F.count("*").alias("offers"))
    matched = offered.join(picks.groupBy(*key).agg(F.count("*").alias("picks")), key, "left").join(runs.select("run_id", DAY), "run_id")
    return matched.groupBy(DAY, "choice_source", "item_id", "rarity").agg(
        F.sum(F.col("offers") * F.coalesce("picks", F.lit(1))).alias("exposure_count"),
        F.sum(F.col("offers") * F.coalesce("picks", F.lit(0))).alias("selection_count"))


def states_of(silver: DataFrame) -> dict[str, DataFrame]:
    """The states of the dates whose Silver rows are given. Picks, offers and runs feed several of them and are stored."""
    picks, offers = stage(selections(silver), "picks"), stage(exposures(silver), "offers")
    runs = stage(run_summary(silver.where(F.col("source_type") == contract.PRODUCT_SOURCE)), "runs")
    return {
        "run_quality": _quality(silver),
        "run_outcome": _outcome(silver),
        "checkpoint_metrics": _checkpoints(silver),
        "run_progression": progression_histogram(runs, DAY),
        "upgrade_post_selection": _after_pick(picks, runs),
        "weapon_popularity": _popularity(offers, picks, runs),
        "weapon_performance": _performance(runs),
        "option_outcome_comparison": _options(offers, picks, runs),
        "upgrade_funnel": _funnel(offers, picks, runs),
    }


def refresh_dates(silver: DataFrame, base: str, received_dates: list[str]) -> None:
    """Replace the states of some dates; `silver` is the whole table, of which only these dates' folders are read."""
    spark = silver.sparkSession
    days = [F.to_date(F.lit(day)) for day in received_dates]
    for table, state in states_of(silver.where(F.col(DAY).isin(*days))).items():
        path = f"{base}/gold_states/{table}"
        rows = stage(state, f"state-{table}")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
        filled = {row[0] for row in rows.select(F.date_format(DAY, "yyyy-MM-dd")).distinct().collect()}
        for day in set(received_dates) - filled:
            remove(spark, f"{path}/{DAY}={day}")


def _merged(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The sum of a table's states over all dates."""
    path = f"{base}/gold_states/{table}"
    if not exists(spark, path):
        raise FileNotFoundError(f"no states of {table} under {base}")
    rows, keys = spark.read.parquet(path), KEYS[table]
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in rows.columns if name not in (*keys, DAY)])


def gold_from_states(spark: SparkSession, base: str, catalog: DataFrame) -> dict[str, DataFrame]:
    """The roll-ups of Gold from the states of all dates."""
    state = {table: _merged(spark, base, table) for table in KEYS}
    observed = F.col("outcome_observed_run_count")
    ended = state["run_outcome"]
    whole = ended.agg(F.sum("ended_run_count").alias("all_ended"))
    outcome = ended.join(F.broadcast(whole)).select(
        "end_reason", "ended_run_count", percentage(F.col("ended_run_count"), F.col("all_ended")).alias("ended_run_percentage"),
        mean_of("average_run_seconds").alias("average_run_seconds"))
    after = stage(state["upgrade_post_selection"].select(
        *_PICK_KEY, "selection_count", "selected_run_count", "outcome_observed_run_count",
        mean_of("average_seconds_after_selection").alias("average_seconds_after_selection"), "death_within_60_seconds_count",
        percentage(F.col("death_within_60_seconds_count"), observed).alias("death_within_60_seconds_percentage"),
        mean_of("average_final_level").alias("average_final_level"), mean_of("average_total_kills").alias("average_total_kills"),
        sample_status(observed).alias("analysis_status")), "post-selection")
    weapons = catalog.where("item_category = 'weapon'").select("game_version", "item_id", "display_name")
    popular = weapons.join(state["weapon_popularity"], ["game_version", "item_id"], "left").select(
        "game_version", F.col("item_id").alias("weapon_id"), "display_name",
        *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in _WEAPON_COUNTS],
        percentage(F.coalesce("selection_count", F.lit(0)), F.nullif(F.col("exposure_count"), F.lit(0))).alias("selection_percentage"))
    names = catalog.where(F.col("choice_source") == _WEAPON_CHOICE).select("game_version", F.col("item_id").alias("weapon_id"), "display_name")
    performance = state["weapon_performance"].join(names, ["game_version", "weapon_id"], "left").select(
        "game_version", "weapon_id", "display_name", "run_count", "outcome_observed_run_count",
        *[mean_of(name).alias(name) for name in _WEAPON_MEANS], cents(F.col("kills") * 60, F.col("seconds")).alias("kills_per_minute"),
        percentage(F.col("deaths"), observed).alias("death_percentage"), sample_status(observed).alias("analysis_status"))
    return {
        "run_quality": state["run_quality"],
        "run_outcome": outcome,
        "checkpoint_metrics": state["checkpoint_metrics"].select(
            "checkpoint_number", "checkpoint_event_count", *[mean_of(f"average_{name}").alias(f"average_{name}") for name in _CHECKPOINT]),
        "run_progression": progression_of(state["run_progression"]),
        "upgrade_post_selection": after,
        "item_performance_summary": item_performance_summary(after, catalog),
        "weapon_popularity": popular,
        "weapon_performance": performance,
        "option_outcome_comparison": _compared(state["option_outcome_comparison"], catalog),
        "upgrade_funnel": state["upgrade_funnel"].withColumn("selection_percentage", percentage(F.col("selection_count"), F.col("exposure_count"))),
    }


def _compared(state: DataFrame, catalog: DataFrame) -> DataFrame:
    def average(arm: str, name: str) -> Column:
        return cents(F.col(f"{arm}_{name}__sum"), F.col(f"{arm}_{name}__n"))

    def difference(name: str) -> Column:
        (a, n), (b, m) = [(F.col(f"{arm}_{name}__sum"), F.col(f"{arm}_{name}__n")) for arm in _ARMS]
        return cents(a * m - b * n, n * m)

    items = state.select(
        *ITEM_KEY, "offered_run_count", *[f"{arm}_run_count" for arm in _ARMS], *[f"{arm}_outcome_run_count" for arm in _ARMS],
        *[average(arm, "total_kills").alias(f"{arm}_average_kills") for arm in _ARMS], difference("total_kills").alias("average_kill_difference"),
        *[average(arm, "run_duration_seconds").alias(f"{arm}_average_run_seconds") for arm in _ARMS],
        difference("run_duration_seconds").alias("average_run_seconds_difference"),
        sample_status(*[F.col(f"{arm}_outcome_run_count") for arm in _ARMS]).alias("analysis_status"))
    return items.join(catalog.select(*ITEM_KEY, "display_name", "item_category"), ITEM_KEY, "left")
