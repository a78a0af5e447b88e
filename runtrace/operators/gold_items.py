"""What players are offered and pick, and how their runs end afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.functions.numeric import cents, exact, mean, percentage
from runtrace.functions.payload import OPTIONS_TYPE, each, field, product_events

ITEM_KEY = ["game_version", "choice_source", "item_id"]


def sample_status(*observed: Column) -> Column:
    """Too few observed outcomes in any arm make a row descriptive of nothing."""
    short = observed[0] < contract.MIN_SAMPLE
    for count in observed[1:]:
        short = short | (count < contract.MIN_SAMPLE)
    return F.when(short, "INSUFFICIENT_SAMPLE").otherwise("DESCRIPTIVE_ONLY")


def side_by_run(rows: DataFrame) -> DataFrame:
    """One side of a join whose rows grow with the runs. It is never broadcast: the packed bytes by which Spark would decide are
    a small part of the rows that would have to pass through the driver."""
    return rows.hint("merge")


def selections(silver: DataFrame) -> DataFrame:
    """Picks of product runs, one typed row each. Several Gold tables read them, so store them first."""
    columns = ["run_id", "game_version", "event_sequence", "run_elapsed_seconds"]
    return product_events(silver, "upgrade_selected", *columns).select(
        *columns,
        field(F.col("p"), "choice_id").alias("choice_id"),
        field(F.col("p"), "choice_source").alias("choice_source"),
        field(F.col("p"), "selected_item_id").alias("item_id"),
        field(F.col("p"), "selected_rarity").alias("rarity"),
    )


def exposures(silver: DataFrame) -> DataFrame:
    """Options offered in product runs, one typed row each; choices without options give none. Store them, too."""
    shown = product_events(silver, "upgrade_options_shown", "run_id", "game_version").select(
        "run_id",
        "game_version",
        field(F.col("p"), "choice_id").alias("choice_id"),
        field(F.col("p"), "choice_source").alias("choice_source"),
        field(F.col("p"), "options", OPTIONS_TYPE).alias("options"),
    )
    kept = ["run_id", "game_version", "choice_id", "choice_source"]
    return each(shown, kept, F.col("options"), "option").select(*kept, "option.*")


def first_picks(picks: DataFrame) -> DataFrame:
    """Each run's first pick of each item with its repeat count.

    Earliest by elapsed time, then sequence: a minimum over a struct, so the picks of one run and item are
    combined before the shuffle and never gathered.
    """
    first = F.min(F.struct("run_elapsed_seconds", "event_sequence", "choice_source", "rarity"))
    return (
        picks.groupBy("run_id", "item_id")
        .agg(
            F.max("game_version").alias("game_version"),
            first.alias("first"),
            F.count("*").alias("selection_count_in_run"),
        )
        .select(
            "run_id",
            "game_version",
            "first.choice_source",
            "item_id",
            "first.rarity",
            F.col("first.run_elapsed_seconds").alias("first_selected_at_seconds"),
            F.floor(F.col("first.run_elapsed_seconds") / 60).alias("selection_minute"),
            "selection_count_in_run",
        )
    )


def upgrade_post_selection(picks: DataFrame, product_runs: DataFrame) -> DataFrame:
    """Outcomes after the first pick, by version, source, item, rarity and minute of the pick."""
    outcomes = product_runs.select(
        "run_id", "is_ended", "end_reason", "final_level", "total_kills", "run_duration_seconds"
    )
    ended = F.col("is_ended")
    remaining = F.when(
        ended & F.col("run_duration_seconds").isNotNull(),
        F.greatest(exact(F.col("run_duration_seconds")) - exact(F.col("first_selected_at_seconds")), exact(F.lit(0))),
    )
    judged = first_picks(picks).join(side_by_run(outcomes), "run_id").withColumn("remaining", remaining)
    died_soon = ended & (F.col("end_reason") == "player_death") & (F.col("remaining") <= 60)
    observed = F.count_if(ended)
    return judged.groupBy(
        "game_version", "choice_source", "item_id", "rarity", "selection_minute"
    ).agg(
        F.sum("selection_count_in_run").alias("selection_count"),
        F.count("*").alias("selected_run_count"),
        observed.alias("outcome_observed_run_count"),
        mean(F.col("remaining")).alias("average_seconds_after_selection"),
        F.count_if(died_soon).alias("death_within_60_seconds_count"),
        percentage(F.count_if(died_soon), observed).alias("death_within_60_seconds_percentage"),
        mean(F.when(ended, F.col("final_level"))).alias("average_final_level"),
        mean(F.when(ended, F.col("total_kills"))).alias("average_total_kills"),
        sample_status(observed).alias("analysis_status"),
    )


def item_performance_summary(post_selection: DataFrame, catalog: DataFrame) -> DataFrame:
    """Post-selection rows rolled up to items: means of the stored (rounded) means, weighted by observed runs."""
    observed = F.sum("outcome_observed_run_count")

    def weighted(name: str) -> Column:
        return cents(
            F.sum(F.coalesce(F.col(name), F.lit(0).cast("decimal(38,2)")) * F.col("outcome_observed_run_count")),
            observed,
        )

    items = post_selection.groupBy(*ITEM_KEY).agg(
        F.sum("selection_count").alias("selection_count"),
        F.sum("selected_run_count").alias("selected_run_count"),
        observed.alias("outcome_observed_run_count"),
        weighted("average_seconds_after_selection").alias("average_seconds_after_selection"),
        F.sum("death_within_60_seconds_count").alias("death_within_60_seconds_count"),
        percentage(F.sum("death_within_60_seconds_count"), observed).alias("death_within_60_seconds_percentage"),
        weighted("average_final_level").alias("average_final_level"),
        weighted("average_total_kills").alias("average_total_kills"),
        sample_status(observed).alias("analysis_status"),
    )
    attributes = ["display_name", "item_category", "intended_effect", "primary_metric", "rarity_scaled",
                  "metric_readiness"]
    measures = [name for name in items.columns if name not in ITEM_KEY]
    return items.join(catalog.select(*ITEM_KEY, *attributes), ITEM_KEY, "left").select(
        *ITEM_KEY, *attributes, *measures
    )


def option_outcome_comparison(
    offers: DataFrame, picks: DataFrame, product_runs: DataFrame, catalog: DataFrame
) -> DataFrame:
    """Ended runs that were offered an option, with and without picking it.

    Both sides of the pick join are distinct on its key, and the result is one row per item before the catalog
    is joined.
    """
    key = ["run_id", "choice_source", "item_id"]
    offered = offers.select("run_id", *ITEM_KEY).distinct()
    picked = picks.select(*key).distinct().withColumn("picked", F.lit(True))
    outcomes = product_runs.select("run_id", "is_ended", "run_duration_seconds", "total_kills")
    observations = (
        offered.join(side_by_run(outcomes), "run_id")
        .join(side_by_run(picked), key, "left")
        .withColumn("picked", F.coalesce("picked", F.lit(False)))
    )
    arms = {"selected": F.col("picked"), "not_selected": ~F.col("picked")}
    observed = {arm: F.count_if(inside & F.col("is_ended")) for arm, inside in arms.items()}

    def arm_sum(arm: str, name: str) -> Column:
        return F.sum(F.when(arms[arm] & F.col("is_ended"), exact(F.col(name))))

    def arm_size(arm: str, name: str) -> Column:
        return F.count(F.when(arms[arm] & F.col("is_ended"), F.col(name)))

    def difference(name: str) -> Column:
        """Rounded only after the subtraction, as one fraction over both arm sizes."""
        top = arm_sum("selected", name) * arm_size("not_selected", name) - arm_sum("not_selected", name) * arm_size(
            "selected", name
        )
        return cents(top, arm_size("selected", name) * arm_size("not_selected", name))

    items = observations.groupBy(*ITEM_KEY).agg(
        F.count("*").alias("offered_run_count"),
        F.count_if(arms["selected"]).alias("selected_run_count"),
        F.count_if(arms["not_selected"]).alias("not_selected_run_count"),
        observed["selected"].alias("selected_outcome_run_count"),
        observed["not_selected"].alias("not_selected_outcome_run_count"),
        *[
            cents(arm_sum(arm, "total_kills"), arm_size(arm, "total_kills")).alias(f"{arm}_average_kills")
            for arm in arms
        ],
        difference("total_kills").alias("average_kill_difference"),
        *[
            cents(arm_sum(arm, "run_duration_seconds"), arm_size(arm, "run_duration_seconds")).alias(
                f"{arm}_average_run_seconds"
            )
            for arm in arms
        ],
        difference("run_duration_seconds").alias("average_run_seconds_difference"),
        sample_status(observed["selected"], observed["not_selected"]).alias("analysis_status"),
    )
    attributes = ["display_name", "item_category"]
    measures = [name for name in items.columns if name not in ITEM_KEY]
    return items.join(catalog.select(*ITEM_KEY, *attributes), ITEM_KEY, "left").select(
        *ITEM_KEY, *attributes, *measures
    )


def upgrade_funnel(offers: DataFrame, picks: DataFrame) -> DataFrame:
    """Exposures and selections by source, item and rarity.

    Both sides are counted per choice before the join. An option offered in several rarities, or picked several
    times, meets every matching pick: the counts multiply instead of the rows.
    """
    key = ["run_id", "choice_id", "item_id"]
    offered = offers.groupBy(*key, "choice_source", "rarity").agg(F.count("*").alias("offers"))
    picked = picks.groupBy(*key).agg(F.count("*").alias("picks"))
    matched = offered.join(side_by_run(picked), key, "left")
    exposure_count = F.sum(F.col("offers") * F.coalesce("picks", F.lit(1)))
    selection_count = F.sum(F.col("offers") * F.coalesce("picks", F.lit(0)))
    return matched.groupBy("choice_source", "item_id", "rarity").agg(
        exposure_count.alias("exposure_count"),
        selection_count.alias("selection_count"),
        percentage(selection_count, exposure_count).alias("selection_percentage"),
    )


def uncatalogued_items(picks: DataFrame, catalog: DataFrame) -> DataFrame:
    """Picked items without a catalog entry for their version."""
    return picks.select(*ITEM_KEY).distinct().join(catalog.select(*ITEM_KEY), ITEM_KEY, "left_anti")
