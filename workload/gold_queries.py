"""Gold queries over clean Silver rows, and everything served from stored Gold tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from runtrace.labels import COLUMN_LABELS, VALUE_LABELS
from runtrace.operators import gold_items, gold_progression, gold_runs, gold_states, gold_weapons, semantic, serve
from runtrace.operators.quality import ObservedGate, quality_checks
from runtrace.operators.reconcile import METRICS, duplicate_keys, metric_differences, metric_summaries
from runtrace.operators.report import checked_report, leading_items, section_rows, steepest_dropoffs
from runtrace.schemas import GOLD, gold_columns
from runtrace.sources.lake import new_gold, put_gold, read_gold, save_gold
from runtrace.sources.staging import exists, new_folder, stage
from workload import gold_sql as S
from workload.projection import catalog, silver, stored
from workload.registry import Query, comparable


def gold(spark, sf_dir, name):
    """A Gold table by name, from Silver alone."""
    events = silver(spark, sf_dir)
    if name in ("run_summary", "run_quality", "run_outcome", "checkpoint_metrics", "product_run_summary"):
        return getattr(gold_runs, name)(events)
    if name == "upgrade_funnel":
        return gold_items.upgrade_funnel(offers(spark, sf_dir), picks(spark, sf_dir))
    runs = product_runs(spark, sf_dir)
    if name == "run_progression":
        return gold_progression.run_progression(runs)
    if name == "upgrade_post_selection":
        return gold_items.upgrade_post_selection(picks(spark, sf_dir), runs)
    items = catalog(spark, sf_dir)
    if name == "item_performance_summary":
        return gold_items.item_performance_summary(gold_items.upgrade_post_selection(picks(spark, sf_dir), runs), items)
    if name == "weapon_performance":
        return gold_weapons.weapon_performance(runs, items)
    function = {
        "weapon_popularity": gold_weapons.weapon_popularity,
        "option_outcome_comparison": gold_items.option_outcome_comparison,
    }[name]
    return function(offers(spark, sf_dir), picks(spark, sf_dir), runs, items)


def product_runs(spark, sf_dir):
    """The stored summary of product runs, which most Gold tables read: the events of a run are grouped once for all of them."""
    return spark.read.parquet(stored(
        spark, sf_dir, "product-runs", lambda to: gold_runs.product_run_summary(silver(spark, sf_dir)).write.parquet(to)))


def picks(spark, sf_dir):
    """The stored, typed picks that several Gold tables read."""
    return spark.read.parquet(stored(
        spark, sf_dir, "picks", lambda to: gold_items.selections(silver(spark, sf_dir)).write.parquet(to)))


def offers(spark, sf_dir):
    return spark.read.parquet(stored(
        spark, sf_dir, "offers", lambda to: gold_items.exposures(silver(spark, sf_dir)).write.parquet(to)))


def kept(spark, sf_dir, name):
    """A stored Gold table with its published columns; run_summary holds product runs, all_runs every run."""
    table = {"all_runs": "run_summary"}.get(name, name)

    def write(path):
        rows = gold(spark, sf_dir, "product_run_summary" if name == "run_summary" else table)
        rows.select(*gold_columns(table)).write.parquet(path)

    return spark.read.parquet(stored(spark, sf_dir, f"gold-{name}", write))


def all_kept(spark, sf_dir):
    return {name: kept(spark, sf_dir, name) for name in GOLD}


def _table(name: str, sql: str) -> Query:
    return Query(lambda spark, sf_dir: comparable(gold(spark, sf_dir, name)), S.select(sql))


def _served(function, sql: str, table: str = "run_summary") -> Query:
    return Query(lambda spark, sf_dir: comparable(function(kept(spark, sf_dir, table))), S.select(sql))


def _listed(table: str, sql_table: str) -> Query:
    columns = ", ".join(serve._LISTINGS[table][0])
    return _served(lambda rows: serve.listing(table, rows), f"{columns} FROM {sql_table}", table)


def ratio(top: str, bottom: str) -> str:
    """top / bottom to six decimals, half away from zero, for values that are not negative."""
    return (
        f"(CASE WHEN ({bottom}) = 0 THEN NULL ELSE (2000000 * cast({top} as hugeint) + cast({bottom} as hugeint)) "
        f"// (2 * cast({bottom} as hugeint)) END)::double / 1000000"
    )


def _metrics(dimension: str, column: str) -> Query:
    kills = "coalesce(sum(total_kills), 0)"
    seconds = f"coalesce(sum({S.micro('run_duration_seconds')}), 0)"
    sql = f"""{column} AS {dimension}, count(run_id) AS run_count, cast(count_if(is_started) as bigint) AS started_run_count,
      cast(count_if(is_ended) as bigint) AS ended_run_count, cast(count_if(NOT is_ended) as bigint) AS incomplete_run_count,
      {ratio(kills, 'count(total_kills)')} AS average_kill_count, {S.big('sum(total_kills)')} AS total_kill_count,
      {ratio(seconds, '1000000 * count(run_duration_seconds)')} AS average_run_seconds,
      CASE WHEN sum(total_kills) IS NOT NULL THEN {ratio(f'60000000 * {kills}', seconds)} END AS kills_per_minute,
      {ratio("100 * count_if(end_reason = 'player_death')", 'count_if(is_ended)')} AS death_percentage
      FROM product GROUP BY {column}"""
    return _served(lambda runs: _all_metrics(semantic.runs_view(), runs, [dimension]), sql)


def _all_metrics(view, rows, dimensions):
    return view.query(rows, dimensions, list(view.metrics))


def _view(view, table: str, sql_table: str, dimensions: dict[str, str], aggregates: str) -> Query:
    """`dimensions` maps public names to the columns of the check SQL."""
    named = ", ".join(f"{column} AS {name}" for name, column in dimensions.items())
    return _served(
        lambda rows: _all_metrics(view(), rows, list(dimensions)),
        f"{named}, {aggregates} FROM {sql_table} GROUP BY {', '.join(dimensions.values())}",
        table,
    )


def _top(order: str) -> str:
    return f"ORDER BY {order} LIMIT 20"


ADJUSTED = f"""{S.big('sum(starting_run_count)')} AS starting_run_count, {S.big('sum(exposure_count)')} AS exposure_count,
  {S.big('sum(selection_count)')} AS selection_count,
  {S.big('sum(first_selected_run_count)')} AS first_selected_run_count,
  {ratio('100 * sum(selection_count)', 'sum(exposure_count)')} AS exposure_adjusted_selection_percentage"""
PERFORMANCE = f"""{S.big('sum(outcome_observed_run_count)')} AS observed_run_count,
  max(average_total_kills) AS average_kill_count, max(kills_per_minute) AS kills_per_minute,
  max(average_run_seconds) AS average_survival_seconds, max(death_percentage) AS death_percentage"""
OPTIONS = f"""{S.big('sum(offered_run_count)')} AS offered_run_count, {S.big('sum(selected_run_count)')} AS selected_run_count,
  {S.big('sum(not_selected_run_count)')} AS not_selected_run_count,
  max(selected_average_kills) AS selected_average_kills,
  max(not_selected_average_kills) AS not_selected_average_kills,
  max(average_kill_difference) AS average_kill_difference,
  max(average_run_seconds_difference) AS average_survival_seconds_difference"""

ENDINGS = f"""coalesce(end_reason, 'incomplete') AS end_reason,
  CASE WHEN end_reason = 'player_death' THEN coalesce(death_cause, 'not_collected_legacy')
       ELSE 'not_applicable' END AS death_cause,
  count(*) AS run_count, {S.mean('run_duration_seconds')} AS average_run_seconds FROM product GROUP BY 1, 2"""


def _summary_sql() -> str:
    def part(key: str, table: str, metrics: list[str], group: str = "") -> str:
        values = ", ".join(f"cast(coalesce({m}, 0) as double) AS metric_{i}_count" for i, m in enumerate(metrics, 1))
        return f"SELECT {key} AS dataset_key, count(*) AS row_count, {values} FROM {table} {group}"

    def sums(*names: str) -> list[str]:
        return [f"sum({name})" for name in names]

    thin = "count_if(analysis_status = 'INSUFFICIENT_SAMPLE')"
    parts = [
        part("'run_quality:' || run_status", "run_quality",
             sums("run_count", "input_event_count", "unique_event_count", "exact_retry_count",
                  "conflicting_duplicate_count"), "GROUP BY run_status"),
        part("'run_progression'", "run_progression",
             [*sums("started_run_count", "reached_run_count", "previous_reached_run_count"),
              "count_if(reached_run_count < previous_reached_run_count)", "count_if(step_dropoff_percentage > 0)"]),
        part("'item_performance_summary'", "item_performance",
             [*sums("selection_count", "selected_run_count", "outcome_observed_run_count",
                    "death_within_60_seconds_count"), thin]),
        part("'weapon_popularity'", "weapon_popularity",
             [*sums("starting_run_count", "exposure_count", "selection_count", "first_selected_run_count"),
              "count_if(selection_percentage > 0)"]),
        part("'weapon_performance'", "weapon_performance",
             [*sums("run_count", "outcome_observed_run_count"),
              "cast(sum(cast(round(average_total_kills * 100) as bigint)) as double) / 100", thin,
              "count_if(death_percentage > 0)"]),
        part("'option_outcome_comparison'", "option_outcomes",
             sums("offered_run_count", "selected_run_count", "not_selected_run_count", "selected_outcome_run_count",
                  "not_selected_outcome_run_count")),
    ]
    return f"{S.base()},\nsummaries AS ({' UNION ALL '.join(parts)})"


def _altered(df):
    """A second copy of the summaries that differs: one row gone, one value off, one within tolerance."""
    key = F.col("dataset_key")
    off = F.when(key == "run_progression", 3).when(key == "weapon_popularity", 0.005).otherwise(0)
    return df.where(key != "weapon_performance").withColumn(
        "metric_1_count", (F.col("metric_1_count") + off).cast("string")
    ).toDF(*[name.upper() for name in df.columns])


def _reconcile(spark, sf_dir):
    rows = metric_summaries(all_kept(spark, sf_dir))
    found = metric_differences(rows, _altered(rows), ["dataset_key"], METRICS)
    return found.select(F.col("key")[0].alias("dataset_key"), "column", "left_value", "right_value", "reason")


def _quality_sql() -> str:
    """Counts of failing rows; only the catalog without one weapon makes checks fail here."""
    def check(name: str, sql: str) -> str:
        return f"SELECT '{name}' AS check_name, cast(({sql}) as bigint) AS failed_row_count"

    def rows(table: str, condition: str) -> str:
        return f"SELECT count(*) FROM {table} WHERE {condition}"

    checks = [
        check("run_quality_non_negative", rows("run_quality", "least(run_count, input_event_count, unique_event_count, "
              "exact_retry_count, conflicting_duplicate_count) < 0")),
        check("run_summary_consistency", rows(
            "runs", "is_ended <> (run_status = 'valid') OR (is_ended AND (end_reason IS NULL OR final_level IS NULL "
            "OR total_kills IS NULL OR current_gold IS NULL)) OR (death_cause IS NOT NULL AND "
            "end_reason <> 'player_death') OR upgrade_selected_count > upgrade_shown_count")),
        check("run_outcome_percentage", "SELECT count(*) FROM (SELECT sum(ended_run_percentage) AS s FROM run_outcome)"
              " WHERE abs(s - 100) > 0.1"),
        check("checkpoint_value_ranges", rows("checkpoint_metrics", "checkpoint_number < 1 OR "
              "average_hp_percent NOT BETWEEN 0 AND 100 OR average_xp_to_next_level <= 0")),
        check("run_progression_ranges", rows("run_progression", "reached_run_count > previous_reached_run_count OR "
              "previous_reached_run_count > started_run_count OR reach_percentage NOT BETWEEN 0 AND 100")),
        check("upgrade_post_selection_ranges", rows("upgrade_post_selection", "selected_run_count > selection_count OR "
              "outcome_observed_run_count > selected_run_count OR (outcome_observed_run_count < 30) <> "
              "(analysis_status = 'INSUFFICIENT_SAMPLE')")),
        check("item_performance_summary_ranges", rows("item_performance", "selected_run_count > selection_count OR "
              "item_id = 'steak'")),
        check("weapon_popularity_ranges", rows("weapon_popularity", "exposed_run_count > exposure_count OR "
              "selected_run_count > selection_count OR first_selected_run_count > selected_run_count OR "
              "selection_count > exposure_count")),
        check("weapon_performance_ranges", rows("weapon_performance", "outcome_observed_run_count > run_count OR "
              "death_percentage NOT BETWEEN 0 AND 100")),
        check("option_outcome_comparison_ranges", rows("option_outcomes", "selected_run_count + not_selected_run_count "
              "<> offered_run_count")),
        check("item_catalog_coverage", "SELECT count(*) FROM (SELECT DISTINCT game_version, choice_source, item_id "
              "FROM picks WHERE item_id = 'steak')"),
        check("upgrade_funnel_ranges", rows("funnel", "selection_count > exposure_count")),
    ]
    union = " UNION ALL ".join(checks)
    return (f"{S.base()}\nSELECT check_name, failed_row_count, CASE WHEN failed_row_count = 0 THEN 'PASS' ELSE 'FAIL' "
            f"END AS check_status FROM ({union})")


def _quality_tables(spark, sf_dir):
    """The gate with one weapon missing from the catalog that Gold was built with, too."""
    items = catalog(spark, sf_dir).where("item_id <> 'steak'")
    tables = {**all_kept(spark, sf_dir), "run_summary": kept(spark, sf_dir, "all_runs")}
    tables["item_performance_summary"] = gold_items.item_performance_summary(
        tables["upgrade_post_selection"], items
    )
    return quality_checks(tables, picks(spark, sf_dir), items)


#: Columns of Gold tables that are made wrong, in words that both engines understand: condition and value.
_NUMBER = "cast(substring(run_id, 33, 4) as int)"
_WRONG = {
    "run_quality": {"exact_retry_count": [("run_status = 'valid'", "-1")], "run_count": [("run_status = 'incomplete'", "-run_count")]},
    "run_summary": {
        "input_event_count": [(f"{_NUMBER} % 7 = 1", "input_event_count + 1")],
        "total_kills": [(f"{_NUMBER} % 11 = 2", "NULL")],
        "upgrade_selected_count": [(f"{_NUMBER} % 13 = 3", "upgrade_shown_count + 1")],
        "run_status": [(f"{_NUMBER} % 17 = 4", "'invalid'")],
        "death_cause": [(f"{_NUMBER} % 19 = 5 AND end_reason <> 'player_death'", "'fall'")],
    },
    "run_outcome": {"ended_run_percentage": [("end_reason = 'player_death'", "ended_run_percentage + 1")]},
    "checkpoint_metrics": {
        "average_hp_percent": [("checkpoint_number = 1", "100.5")], "average_xp_to_next_level": [("checkpoint_number = 2", "0")],
        "average_current_gold": [("checkpoint_number = 3", "-1")], "checkpoint_event_count": [("checkpoint_number = 4", "0")],
    },
    "run_progression": {
        "reached_run_count": [("checkpoint_number % 4 = 0", "previous_reached_run_count + 1")],
        "elapsed_minutes": [("checkpoint_number % 4 = 1", "elapsed_minutes + 1")], "reach_percentage": [("checkpoint_number % 4 = 2", "-1")],
    },
    "upgrade_post_selection": {
        "selected_run_count": [("selection_minute % 5 = 0", "selection_count + 1")],
        "analysis_status": [("selection_minute % 5 = 1", "'DESCRIPTIVE_ONLY'"), ("selection_minute % 5 = 3", "'OTHER'")],
        "death_within_60_seconds_percentage": [("selection_minute % 5 = 2", "-1")],
    },
    "item_performance_summary": {
        "intended_effect": [("choice_source = 'statue'", "NULL")],
        "outcome_observed_run_count": [("game_version = '1.1.0'", "selected_run_count + 1")],
    },
    "weapon_popularity": {
        "display_name": [("weapon_id = 'bone'", "NULL")], "selection_percentage": [("weapon_id = 'sword'", "100.01")],
        "exposed_run_count": [("game_version = '1.2.0'", "exposure_count + 1")],
    },
    "weapon_performance": {"death_percentage": [("game_version = '1.0.0'", "-0.5")], "run_count": [("game_version = '1.1.0'", "0")]},
    "option_outcome_comparison": {
        "offered_run_count": [("choice_source = 'level_up_weapon'", "offered_run_count + 1")],
        "analysis_status": [("choice_source = 'statue'", "'OTHER'")],
    },
    "upgrade_funnel": {"selection_count": [("rarity = 'common'", "exposure_count + 1")], "exposure_count": [("rarity = 'rare'", "0")]},
}
_SQL_NAMES = {"run_summary": f"(SELECT {S.RUN_COLUMNS} FROM runs)", "item_performance_summary": "item_performance", "option_outcome_comparison": "option_outcomes",
              "upgrade_funnel": "funnel"}


def _made_wrong(table: str) -> dict[str, str]:
    return {column: "CASE " + " ".join(f"WHEN {when} THEN {value}" for when, value in cases) + f" ELSE {column} END"
            for column, cases in _WRONG[table].items()}


def _quality_observed(spark, sf_dir):
    """The gate over Gold tables with wrong rows, counted while these are written."""
    gate = ObservedGate()
    for table in GOLD:
        rows = kept(spark, sf_dir, "all_runs" if table == "run_summary" else table)
        kinds = dict(rows.dtypes)
        gate.put(table, rows.withColumns({c: F.expr(text).cast(kinds[c]) for c, text in _made_wrong(table).items()}))
    gate.put_picks(picks(spark, sf_dir), catalog(spark, sf_dir).where("item_id <> 'steak'"))
    return gate.table(spark)


def _observed_sql() -> str:
    """Every condition of the twelve checks, over the same wrong rows."""
    wrong = ",\n".join(
        f"wrong_{table} AS (SELECT * REPLACE ({', '.join(f'{text} AS {c}' for c, text in _made_wrong(table).items())}) "
        f"FROM {_SQL_NAMES.get(table, table)})" for table in _WRONG)
    sample = "analysis_status NOT IN ('INSUFFICIENT_SAMPLE', 'DESCRIPTIVE_ONLY')"
    thin = f"{sample} OR (outcome_observed_run_count < 30) <> (analysis_status = 'INSUFFICIENT_SAMPLE')"
    after = f"""selection_count < 1 OR selected_run_count < 1 OR selected_run_count > selection_count OR outcome_observed_run_count < 0
      OR outcome_observed_run_count > selected_run_count OR death_within_60_seconds_count < 0
      OR death_within_60_seconds_count > outcome_observed_run_count OR death_within_60_seconds_percentage NOT BETWEEN 0 AND 100
      OR average_seconds_after_selection < 0 OR average_final_level < 0 OR average_total_kills < 0 OR {thin}"""
    rules = {
        "run_quality_non_negative": ("run_quality", "least(run_count, input_event_count, unique_event_count, exact_retry_count, "
                                     "conflicting_duplicate_count) < 0"),
        "run_summary_consistency": ("run_summary", """is_ended AND run_status <> 'valid' OR NOT is_ended AND run_status <> 'incomplete'
          OR is_ended AND (end_reason IS NULL OR run_duration_seconds IS NULL OR final_level IS NULL OR total_kills IS NULL OR current_gold IS NULL)
          OR death_cause IS NOT NULL AND end_reason <> 'player_death' OR upgrade_selected_count > upgrade_shown_count
          OR input_event_count <> unique_event_count + exact_retry_count + conflicting_duplicate_count"""),
        "checkpoint_value_ranges": ("checkpoint_metrics", """checkpoint_number < 1 OR checkpoint_event_count < 1 OR average_player_level < 0
          OR average_current_xp < 0 OR average_xp_to_next_level <= 0 OR average_hp_percent NOT BETWEEN 0 AND 100 OR average_total_kills < 0
          OR average_current_gold < 0"""),
        "run_progression_ranges": ("run_progression", """checkpoint_number < 1 OR elapsed_minutes <> checkpoint_number OR started_run_count < 1
          OR reached_run_count < 0 OR reached_run_count > previous_reached_run_count OR previous_reached_run_count > started_run_count
          OR reach_percentage NOT BETWEEN 0 AND 100 OR step_dropoff_percentage NOT BETWEEN 0 AND 100"""),
        "upgrade_post_selection_ranges": ("upgrade_post_selection", after),
        "item_performance_summary_ranges": ("item_performance_summary", f"""display_name IS NULL OR item_category IS NULL
          OR intended_effect IS NULL OR primary_metric IS NULL OR metric_readiness IS NULL OR {after}"""),
        "weapon_popularity_ranges": ("weapon_popularity", """display_name IS NULL OR least(starting_run_count, exposure_count,
          exposed_run_count, selection_count, selected_run_count, first_selected_run_count) < 0 OR exposed_run_count > exposure_count
          OR selected_run_count > selection_count OR first_selected_run_count > selected_run_count OR selection_count > exposure_count
          OR selection_percentage NOT BETWEEN 0 AND 100"""),
        "weapon_performance_ranges": ("weapon_performance", f"""display_name IS NULL OR run_count < 1 OR outcome_observed_run_count < 0
          OR outcome_observed_run_count > run_count OR average_run_seconds < 0 OR average_total_kills < 0 OR kills_per_minute < 0
          OR average_final_level < 0 OR average_total_xp < 0 OR average_total_gold < 0 OR death_percentage NOT BETWEEN 0 AND 100 OR {thin}"""),
        "option_outcome_comparison_ranges": ("option_outcome_comparison", f"""display_name IS NULL OR item_category IS NULL
          OR offered_run_count < 1 OR selected_run_count < 0 OR not_selected_run_count < 0
          OR selected_run_count + not_selected_run_count <> offered_run_count OR selected_outcome_run_count < 0
          OR selected_outcome_run_count > selected_run_count OR not_selected_outcome_run_count < 0
          OR not_selected_outcome_run_count > not_selected_run_count OR selected_average_kills < 0 OR not_selected_average_kills < 0
          OR selected_average_run_seconds < 0 OR not_selected_average_run_seconds < 0 OR {sample}
          OR (least(selected_outcome_run_count, not_selected_outcome_run_count) < 30) <> (analysis_status = 'INSUFFICIENT_SAMPLE')"""),
        "upgrade_funnel_ranges": ("upgrade_funnel", """exposure_count < 1 OR selection_count < 0 OR selection_count > exposure_count
          OR selection_percentage NOT BETWEEN 0 AND 100"""),
    }
    parts = [f"SELECT '{check}' AS check_name, count(*) AS n FROM wrong_{table} WHERE {broken}" for check, (table, broken) in rules.items()]
    parts.append("SELECT 'run_outcome_percentage', CASE WHEN abs(sum(ended_run_percentage) - 100) > 0.1 THEN 1 ELSE 0 END FROM wrong_run_outcome")
    parts.append("SELECT 'item_catalog_coverage', count(*) FROM (SELECT DISTINCT game_version, choice_source, item_id FROM picks WHERE item_id = 'steak')")
    return (f"{S.base()},\n{wrong}\nSELECT check_name, cast(n as bigint) AS failed_row_count, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END "
            f"AS check_status FROM ({' UNION ALL '.join(parts)})")


def _gold_published(spark, sf_dir):
    """Gold stored and put in force as one version, twice; metric summaries of the tables that readers find then."""
    base = new_folder(spark, "lake")
    for number in (1, 2):
        folder = new_gold(base, number)
        for name, rows in all_kept(spark, sf_dir).items():
            save_gold(rows, folder, name)
        put_gold(spark, base, folder, number)
    return comparable(metric_summaries(read_gold(spark, base)))


_LONG_KEYS = {
    "run_quality": ["run_status"], "run_outcome": ["end_reason"], "checkpoint_metrics": ["checkpoint_number"],
    "run_progression": ["game_version", "checkpoint_number"],
    "upgrade_post_selection": ["game_version", "choice_source", "item_id", "rarity", "selection_minute", "analysis_status"],
    "item_performance_summary": ["game_version", "choice_source", "item_id", "display_name", "metric_readiness", "analysis_status"],
    "weapon_popularity": ["game_version", "weapon_id", "display_name"],
    "weapon_performance": ["game_version", "weapon_id", "display_name", "analysis_status"],
    "option_outcome_comparison": ["game_version", "choice_source", "item_id", "item_category", "analysis_status"],
    "upgrade_funnel": ["choice_source", "item_id", "rarity"],
}


def _measures(table: str) -> list[str]:
    return [name for name, kind in GOLD[table].items() if name not in _LONG_KEYS[table] and kind not in ("string", "boolean")]


def _gold_incremental(spark, sf_dir):
    """States of all dates, one of them with every second run only; then that date's Silver is replaced and it alone refreshed."""
    base, day = new_folder(spark, "lake"), "2024-01-10"
    events = silver(spark, sf_dir)
    owners = events.groupBy("run_id").agg(F.min("received_date").alias("received_date"))  # as a rebuild stores them
    rows = stage(events.drop("received_date").join(owners, "run_id"), "owned")
    late = (F.col("received_date") == F.lit(day).cast("date")) & (F.crc32(F.col("run_id").cast("binary")) % 2 == 0)
    for part in (rows.where(~late), rows.where(F.col("received_date") == F.lit(day).cast("date"))):
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("received_date").parquet(f"{base}/silver")
        stored_rows = spark.read.parquet(f"{base}/silver")
        dates = [day] if exists(spark, f"{base}/gold_states") else sorted(
            str(r[0]) for r in stored_rows.select("received_date").distinct().collect())
        gold_states.refresh_dates(stored_rows, base, dates)
    tables = gold_states.gold_from_states(spark, base, catalog(spark, sf_dir))
    parts = []
    for table, keys in _LONG_KEYS.items():
        names = _measures(table)
        values = ", ".join(f"'{name}', cast({name} as double)" for name in names)
        parts.append(tables[table].select(
            F.lit(table).alias("gold_table"), F.concat_ws("/", *[F.col(key).cast("string") for key in keys]).alias("row_key"),
            F.expr(f"stack({len(names)}, {values}) AS (measure, value)")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _long_sql() -> str:
    return S.select("* FROM (" + " UNION ALL ".join(
        f"SELECT '{table}' AS gold_table, concat_ws('/', {', '.join(f'cast({key} as varchar)' for key in keys)}) AS row_key, "
        f"'{name}' AS measure, cast({name} as double) AS value FROM {_SQL_NAMES.get(table, table)}"
        for table, keys in _LONG_KEYS.items() for name in _measures(table)) + ")")


def _relabel_sql() -> str:
    values = ", ".join(f"('{a}', '{b}')" for a, b in VALUE_LABELS.items())

    def shown(name: str, text: bool) -> str:
        label = COLUMN_LABELS.get(name, name)
        value = f"coalesce((SELECT max(l.b) FROM labels l WHERE l.a = {name}), {name})" if text else name
        return f'{value} AS "{label}"'

    columns = ", ".join(
        [shown("end_reason", True), shown("death_cause", True), shown("run_count", False),
         shown("average_run_seconds", False)]
    )
    return (f"{S.base()},\nlabels(a, b) AS (VALUES {values}), endings AS (SELECT {ENDINGS})\n"
            f"SELECT {columns} FROM endings")


_REPORT = """struct<
  run_quality:array<struct<run_status:string,run_count:bigint,unique_event_count:bigint>>,
  run_outcomes:array<struct<end_reason:string,ended_run_count:bigint,average_run_seconds:double>>,
  checkpoint_metrics:array<struct<checkpoint_number:bigint,checkpoint_event_count:bigint,average_current_gold:double>>,
  upgrade_funnel:array<struct<choice_source:string,item_id:string,rarity:string,exposure_count:bigint,selection_count:bigint,
    selection_percentage:double>>,
  run_progression:array<struct<game_version:string>>, item_performance_summary:array<struct<item_id:string>>>"""


#: The whole funnel of the test tables takes 26,438 bytes on sf0.001; the contract's 24 KiB hold in `report_payload_sources`.
_REPORT_BYTES = 64 * 1024


def _document(spark, sf_dir):
    """The rows of one checked report document with the whole funnel, under a larger limit of bytes."""
    return _document_rows(checked_report("2024-02-01", section_rows(all_kept(spark, sf_dir)), _REPORT_BYTES))


def _documents(spark, sf_dir):
    """Rows of one checked report for each choice source: with the whole funnel a report is over its limit of 24 KiB."""
    sections = section_rows(all_kept(spark, sf_dir))
    sources = sorted(r[0] for r in sections["upgrade_funnel"].select("choice_source").distinct().collect())
    reports = [_source_document(sections, source).select(F.lit(source).alias("report_source"), "*") for source in sources]
    return reduce(lambda a, b: a.unionByName(b), reports)


def _source_document(sections, source):
    """The rows of the checked report document of one choice source."""
    return _document_rows(checked_report("2024-02-01", {
        **sections, "upgrade_funnel": sections["upgrade_funnel"].where(F.col("choice_source") == source)}))


def _document_rows(document):
    """The rows of a report document, read back from its text."""
    metrics = document.select("report_date", F.from_json(
        "document", f"struct<schema_version:string,metrics:{_REPORT}>").alias("d")).select(
            "report_date", "d.schema_version", "d.metrics.*")

    def rows(section: str, name, count_1, count_2, value):
        entries = metrics.select("report_date", "schema_version", F.explode(section).alias("e"))
        return entries.select("report_date", "schema_version", F.lit(section).alias("section"), name.alias("name"),
                              count_1.cast("bigint").alias("count_1"), count_2.cast("bigint").alias("count_2"), value.cast("double").alias("value"))

    e, none = (lambda name: F.col(f"e.{name}")), F.lit(None)
    parts = [
        rows("run_quality", e("run_status"), e("run_count"), e("unique_event_count"), none),
        rows("run_outcomes", e("end_reason"), e("ended_run_count"), none, e("average_run_seconds")),
        rows("checkpoint_metrics", e("checkpoint_number").cast("string"), e("checkpoint_event_count"), none, e("average_current_gold")),
        rows("upgrade_funnel", F.concat_ws("/", "e.choice_source", "e.item_id", "e.rarity"), e("exposure_count"), e("selection_count"),
             e("selection_percentage")),
    ]
    sizes = [metrics.select("report_date", "schema_version", F.lit(section).alias("section"), F.lit("rows").alias("name"),
                            F.size(section).cast("bigint").alias("count_1"), none.cast("bigint").alias("count_2"), none.cast("double").alias("value"))
             for section in ("run_progression", "item_performance_summary")]
    return reduce(lambda a, b: a.unionByName(b), parts + sizes)


_REPORT_SQL = """'2024-02-01' AS report_date, 'gold-report-input-v1' AS schema_version, * FROM (
  SELECT 'run_quality' AS section, run_status AS name, run_count AS count_1, unique_event_count AS count_2, cast(NULL as double) AS value FROM run_quality
  UNION ALL SELECT 'run_outcomes', end_reason, ended_run_count, NULL, average_run_seconds FROM run_outcome
  UNION ALL SELECT 'checkpoint_metrics', cast(checkpoint_number as varchar), checkpoint_event_count, NULL, average_current_gold FROM checkpoint_metrics
  UNION ALL SELECT 'upgrade_funnel', choice_source || '/' || item_id || '/' || rarity, exposure_count, selection_count, selection_percentage FROM funnel
  UNION ALL SELECT 'run_progression', 'rows', (SELECT least(count(*), 20) FROM run_progression), NULL, NULL
  UNION ALL SELECT 'item_performance_summary', 'rows', (SELECT least(count(*), 20) FROM item_performance WHERE outcome_observed_run_count > 0), NULL, NULL)"""

_REPORTS_SQL = f"""s.choice_source AS report_source, r.* FROM (SELECT DISTINCT choice_source FROM funnel) s, (
  SELECT {_REPORT_SQL}) r
  WHERE r.section <> 'upgrade_funnel' OR starts_with(r.name, s.choice_source || '/')"""


QUERIES = {
    "run_summary": _table("run_summary", f"{S.RUN_COLUMNS} FROM runs"),
    "product_run_summary": _table("product_run_summary", f"{S.RUN_COLUMNS} FROM product"),
    "run_quality": _table("run_quality", "* FROM run_quality"),
    "run_outcome": _table("run_outcome", "* FROM run_outcome"),
    "checkpoint_metrics": _table("checkpoint_metrics", "* FROM checkpoint_metrics"),
    "run_progression": _table("run_progression", "* FROM run_progression"),
    "upgrade_post_selection": _table("upgrade_post_selection", "* FROM upgrade_post_selection"),
    "item_performance": _table("item_performance_summary", "* FROM item_performance"),
    "weapon_popularity": _table("weapon_popularity", "* FROM weapon_popularity"),
    "weapon_performance": _table("weapon_performance", "* FROM weapon_performance"),
    "option_outcomes": _table("option_outcome_comparison", "* FROM option_outcomes"),
    "upgrade_funnel": _table("upgrade_funnel", "* FROM funnel"),
    "item_catalog": Query(lambda spark, sf_dir: catalog(spark, sf_dir), S.select("* FROM catalog")),
    "payload_projection": Query(
        lambda spark, sf_dir: comparable(gold_items.selections(silver(spark, sf_dir))), S.select("* FROM picks")
    ),
    "win_first_pick": Query(
        lambda spark, sf_dir: comparable(gold_items.first_picks(picks(spark, sf_dir))), S.select("* FROM first_picks")
    ),
    "win_share_of_total": Query(
        lambda spark, sf_dir: comparable(
            gold(spark, sf_dir, "run_outcome").select("end_reason", "ended_run_percentage")),
        S.select("end_reason, ended_run_percentage FROM run_outcome"),
    ),
    "win_lag_dropoff": Query(
        lambda spark, sf_dir: comparable(
            gold(spark, sf_dir, "run_progression").select(
                "game_version", "checkpoint_number", "previous_reached_run_count", "step_dropoff_percentage")),
        S.select("game_version, checkpoint_number, previous_reached_run_count, step_dropoff_percentage "
                 "FROM run_progression"),
    ),
    "catalog_coverage": Query(
        lambda spark, sf_dir: gold_items.uncatalogued_items(
            picks(spark, sf_dir), catalog(spark, sf_dir).where("item_id NOT IN ('sword', 'steak')")),
        S.select("DISTINCT game_version, choice_source, item_id FROM picks WHERE item_id IN ('sword', 'steak')"),
    ),
    "versions": _served(serve.versions, "DISTINCT game_version FROM product"),
    "dash_run_overview": _served(
        serve.run_overview,
        f"""count(*) AS total_run_count, cast(count_if(is_started) as bigint) AS started_run_count,
        cast(count_if(is_ended) as bigint) AS ended_run_count, cast(count_if(NOT is_ended) as bigint) AS incomplete_run_count,
        {S.mean('run_duration_seconds')} AS average_run_seconds,
        {S.share('count_if(is_ended)', 'count(*)')} AS ended_percentage,
        {S.share('count_if(NOT is_ended)', 'count(*)')} AS incomplete_percentage,
        {S.cents(f"cast(round(({S.mean('run_duration_seconds')}) * 100) as hugeint)", '6000')} AS average_run_minutes
        FROM product""",
    ),
    "dash_run_endings": _served(serve.run_endings, ENDINGS),
    "dash_death_causes": _served(
        serve.death_causes,
        "coalesce(death_cause, 'not_collected_legacy') AS death_cause, count(*) AS run_count FROM product "
        "WHERE end_reason = 'player_death' GROUP BY 1",
    ),
    "dash_run_progression": _listed("run_progression", "run_progression"),
    "dash_item_performance": _listed("item_performance_summary", "item_performance"),
    "dash_weapon_popularity": _listed("weapon_popularity", "weapon_popularity"),
    "dash_weapon_performance": _served(
        lambda rows: serve.listing("weapon_performance", rows, "1.1.0"),
        f"{', '.join(serve._LISTINGS['weapon_performance'][0])} FROM weapon_performance WHERE game_version = '1.1.0'",
        "weapon_performance",
    ),
    "dash_option_outcomes": _listed("option_outcome_comparison", "option_outcomes"),
    "dash_run_quality": _listed("run_quality", "run_quality"),
    "relabel": Query(
        lambda spark, sf_dir: comparable(serve.relabelled(serve.run_endings(kept(spark, sf_dir, "run_summary")))),
        _relabel_sql(),
    ),
    "metrics_by_weapon": _metrics("starting_weapon", "starting_weapon_id"),
    "metrics_by_version": _metrics("game_version", "game_version"),
    "metrics_by_end_reason": _metrics("end_reason", "end_reason"),
    "metrics_weapon_popularity": _view(
        semantic.weapon_popularity_view, "weapon_popularity", "weapon_popularity", {"game_version": "game_version"},
        ADJUSTED),
    "metrics_weapon_performance": _view(
        semantic.weapon_performance_view, "weapon_performance", "weapon_performance",
        {"game_version": "game_version", "weapon_name": "display_name"}, PERFORMANCE),
    "metrics_options": _view(
        semantic.option_outcomes_view, "option_outcome_comparison", "option_outcomes",
        {"game_version": "game_version", "choice_source": "choice_source", "item_category": "item_category"}, OPTIONS),
    "verified_first_weapon": _served(
        semantic.most_first_selected_weapons,
        f"""game_version, display_name AS weapon_name,
        {S.big('sum(first_selected_run_count)')} AS first_selected_run_count,
        {S.big('sum(exposure_count)')} AS exposure_count,
        {ratio('100 * sum(selection_count)', 'sum(exposure_count)')} AS exposure_adjusted_selection_percentage
        FROM weapon_popularity GROUP BY 1, 2 {_top('first_selected_run_count DESC NULLS LAST, game_version, weapon_name')}""",
        "weapon_popularity",
    ),
    "verified_top_kills": _served(
        semantic.highest_kill_starting_weapons,
        f"""game_version, display_name AS weapon_name, analysis_status AS sample_status,
        {S.big('sum(outcome_observed_run_count)')} AS observed_run_count,
        max(average_total_kills) AS average_kill_count, max(kills_per_minute) AS kills_per_minute
        FROM weapon_performance GROUP BY 1, 2, 3
        {_top('average_kill_count DESC NULLS LAST, game_version, weapon_name, sample_status')}""",
        "weapon_performance",
    ),
    "verified_survival": _served(
        semantic.longer_survival_options,
        f"""game_version, choice_source, display_name AS item_name, item_category, analysis_status AS sample_status,
        {S.big('sum(offered_run_count)')} AS offered_run_count,
        {S.big('sum(selected_run_count)')} AS selected_run_count,
        {S.big('sum(not_selected_run_count)')} AS not_selected_run_count,
        max(average_run_seconds_difference) AS average_survival_seconds_difference
        FROM option_outcomes GROUP BY 1, 2, 3, 4, 5
        {_top('average_survival_seconds_difference DESC NULLS LAST, game_version, choice_source, item_name, item_category, sample_status')}""",
        "option_outcome_comparison",
    ),
    "topk_dropoff": _served(
        steepest_dropoffs,
        f"""game_version, checkpoint_number, started_run_count, reached_run_count, reach_percentage,
        step_dropoff_percentage FROM run_progression
        {_top('step_dropoff_percentage DESC NULLS LAST, game_version, checkpoint_number')}""",
        "run_progression",
    ),
    "topk_items": _served(
        leading_items,
        f"""{', '.join(GOLD['item_performance_summary'])} FROM item_performance WHERE outcome_observed_run_count > 0
        {_top("(analysis_status <> 'DESCRIPTIVE_ONLY'), selected_run_count DESC, game_version, item_id, choice_source")}""",
        "item_performance_summary",
    ),
    "quality_checks": Query(_quality_tables, _quality_sql()),
    "gold_incremental": Query(_gold_incremental, _long_sql()),
    "quality_observed": Query(_quality_observed, _observed_sql()),
    "gold_published": Query(_gold_published, f"{_summary_sql()}\nSELECT * FROM summaries"),
    "reconcile_metrics": Query(
        lambda spark, sf_dir: comparable(metric_summaries(all_kept(spark, sf_dir))),
        f"{_summary_sql()}\nSELECT * FROM summaries",
    ),
    "reconcile": Query(
        lambda spark, sf_dir: comparable(_reconcile(spark, sf_dir)),
        f"""{_summary_sql()}
        SELECT dataset_key, '*' AS "column", cast(NULL as double) AS left_value, cast(NULL as double) AS right_value,
               'missing_in_right' AS reason FROM summaries WHERE dataset_key = 'weapon_performance'
        UNION ALL
        SELECT dataset_key, 'metric_1_count', metric_1_count, metric_1_count + 3, 'value_mismatch'
        FROM summaries WHERE dataset_key = 'run_progression'""",
    ),
    "reconcile_dup_keys": Query(
        lambda spark, sf_dir: duplicate_keys(kept(spark, sf_dir, "upgrade_post_selection"), ["ITEM_ID", "rarity"]),
        S.select("item_id, rarity, count(*) AS row_count FROM upgrade_post_selection GROUP BY ALL HAVING count(*) > 1"),
    ),
    "report_payload": Query(_document, S.select(_REPORT_SQL)),
    "report_payload_sources": Query(_documents, S.select(_REPORTS_SQL)),
}
