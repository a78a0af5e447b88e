"""Check SQL for the Gold tables: computed from the typed projection, without any JSON."""

from __future__ import annotations

from runtrace import contract
from workload.projection import DUCKDB, telemetry_sql


def cents(top: str, bottom: str) -> str:
    """top / bottom rounded half away from zero to cents, on whole numbers only."""
    return (
        f"(CASE WHEN ({bottom}) = 0 THEN NULL WHEN ({top}) < 0 "
        f"THEN -((200 * -cast({top} as hugeint) + cast({bottom} as hugeint)) // (2 * cast({bottom} as hugeint))) "
        f"ELSE (200 * cast({top} as hugeint) + cast({bottom} as hugeint)) // (2 * cast({bottom} as hugeint)) "
        f"END)::double / 100"
    )


def micro(value: str) -> str:
    return f"cast(round(({value}) * 1000000) as hugeint)"


def mean(value: str, where: str = "true") -> str:
    return cents(
        f"coalesce(sum(CASE WHEN {where} THEN {micro(value)} END), 0)",
        f"1000000 * count(CASE WHEN {where} THEN {value} END)",
    )


def share(part: str, whole: str) -> str:
    return cents(f"100 * ({part})", whole)


STATUS = "CASE WHEN {0} < 30 THEN 'INSUFFICIENT_SAMPLE' ELSE 'DESCRIPTIVE_ONLY' END"


def big(value: str) -> str:
    return f"cast({value} as bigint)"


def catalog_cte() -> str:
    rows = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).lower() for v in row) + ")"
        for row in contract.item_rows()
    )
    return f"""
items(choice_source, item_id, display_name, item_category, intended_effect, primary_metric, rarity_scaled,
      metric_readiness) AS (VALUES {rows}),
catalog AS (
  SELECT v.game_version, items.* FROM (SELECT DISTINCT game_version FROM telemetry) v, items
)"""


def _end(column: str) -> str:
    return f"max({column}) FILTER (event_name = 'run_ended')"


def base() -> str:
    """CTEs: telemetry, runs (all sources), product, picks, offers, catalog."""
    return f"""WITH {telemetry_sql(DUCKDB)},
runs AS (
  SELECT run_id, min(day) AS received_date, max(source_type) AS source_type, max(game_version) AS game_version,
    CASE WHEN max(r) % 6 = 0 THEN 'incomplete' ELSE 'valid' END AS run_status,
    bool_or(event_name = 'run_started') AS is_started, bool_or(event_name = 'run_ended') AS is_ended,
    min(us) AS first_us, max(us) AS last_us,
    max(run_elapsed_seconds) AS observed_run_seconds, {_end('run_elapsed_seconds')} AS run_duration_seconds,
    max(event_sequence) AS max_event_sequence,
    max(map_id) AS map_id, max(starting_weapon_id) AS starting_weapon_id, max(starting_max_hp) AS starting_max_hp,
    max(end_reason) AS end_reason, max(death_cause) AS death_cause, max(final_level) AS final_level,
    {_end('total_kills')} AS total_kills, {_end('total_xp_collected')} AS total_xp_collected,
    {_end('current_gold')} AS current_gold, {_end('total_gold_collected')} AS total_gold_collected,
    max(hearts_collected) AS hearts_collected,
    max(CASE WHEN final_item IS NOT NULL THEN 1 END) AS final_upgrade_count,
    max('[{{"acquisition_count":' || cast(final_acquisitions as varchar) || ',"item_id":"' || final_item || '"}}]')
      AS final_upgrades_json,
    count(*) FILTER (event_name = 'run_checkpoint') AS checkpoint_count,
    max(checkpoint_number) AS highest_checkpoint_number,
    count(*) FILTER (event_name = 'upgrade_options_shown') AS upgrade_shown_count,
    count(*) FILTER (event_name = 'upgrade_selected') AS upgrade_selected_count,
    max(e) AS unique_event_count,
    max(r) % 3 AS exact_retry_count, CASE WHEN max(r) % 13 = 0 THEN 1 ELSE 0 END AS conflicting_duplicate_count,
    CASE WHEN max(r) % 6 = 0 THEN 1 ELSE 0 END AS quality_issue_count
  FROM telemetry GROUP BY run_id
),
product AS (SELECT * FROM runs WHERE source_type = 'CONSENTED_PROD_PLAY'),
play AS (SELECT * FROM telemetry WHERE source_type = 'CONSENTED_PROD_PLAY'),
picks AS (
  SELECT run_id, game_version, event_sequence, run_elapsed_seconds, choice_id, choice_source,
         selected_item_id AS item_id, selected_rarity AS rarity
  FROM play WHERE event_name = 'upgrade_selected'
),
offers AS (
  SELECT run_id, game_version, choice_id, choice_source, item_1 AS item_id, rarity_1 AS rarity
  FROM play WHERE event_name = 'upgrade_options_shown'
  UNION ALL
  SELECT run_id, game_version, choice_id, choice_source, item_2, rarity_2
  FROM play WHERE event_name = 'upgrade_options_shown'
  UNION ALL
  SELECT run_id, game_version, choice_id, choice_source, item_3, rarity_3
  FROM play WHERE event_name = 'upgrade_options_shown' AND item_3 IS NOT NULL
),
{catalog_cte()},
{_gold_ctes()}"""


def _gold_ctes() -> str:
    picked, rest = "picked AND is_ended", "NOT picked AND is_ended"

    def diff(column: str) -> str:
        a, b = (f"coalesce(sum(CASE WHEN {w} THEN {micro(column)} END), 0)" for w in (picked, rest))
        m, n = (f"count(CASE WHEN {w} THEN {column} END)" for w in (picked, rest))
        return cents(f"({a} * {n} - {b} * {m})", f"1000000 * {m} * {n}")

    return f"""
run_quality AS (
  SELECT run_status, count(*) AS run_count,
    {big('sum(unique_event_count + exact_retry_count + conflicting_duplicate_count)')} AS input_event_count,
    {big('sum(unique_event_count)')} AS unique_event_count, {big('sum(exact_retry_count)')} AS exact_retry_count,
    {big('sum(conflicting_duplicate_count)')} AS conflicting_duplicate_count
  FROM runs GROUP BY run_status
),
run_outcome AS (
  SELECT end_reason, count(*) AS ended_run_count,
    {share('count(*)', '(SELECT count(*) FROM product WHERE is_ended)')} AS ended_run_percentage,
    {mean('run_duration_seconds')} AS average_run_seconds
  FROM product WHERE is_ended GROUP BY end_reason
),
checkpoint_metrics AS (
  SELECT checkpoint_number, count(*) AS checkpoint_event_count,
    {mean('player_level')} AS average_player_level, {mean('current_xp')} AS average_current_xp,
    {mean('xp_to_next_level')} AS average_xp_to_next_level, {mean('hp_percent')} AS average_hp_percent,
    {mean('total_kills')} AS average_total_kills, {mean('current_gold')} AS average_current_gold
  FROM play WHERE event_name = 'run_checkpoint' GROUP BY checkpoint_number
),
reach AS (
  SELECT s.game_version, c.checkpoint_number, s.started_run_count,
    (SELECT count(*) FROM product q WHERE q.is_started AND q.game_version = s.game_version
       AND q.highest_checkpoint_number >= c.checkpoint_number) AS reached_run_count
  FROM (SELECT game_version, count(*) AS started_run_count, max(highest_checkpoint_number) AS top
        FROM product WHERE is_started GROUP BY game_version) s,
       LATERAL (SELECT unnest(range(1, cast(top as bigint) + 1)) AS checkpoint_number) c
),
stepped AS (
  SELECT reach.*, coalesce(lag(reached_run_count) OVER (PARTITION BY game_version ORDER BY checkpoint_number),
                           started_run_count) AS previous_reached_run_count
  FROM reach
),
run_progression AS (
  SELECT game_version, checkpoint_number, checkpoint_number AS elapsed_minutes, started_run_count,
    reached_run_count, {share('reached_run_count', 'started_run_count')} AS reach_percentage,
    previous_reached_run_count,
    {share('previous_reached_run_count - reached_run_count', 'previous_reached_run_count')} AS step_dropoff_percentage
  FROM stepped
),
numbered_picks AS (
  SELECT picks.*, row_number() OVER (PARTITION BY run_id, item_id ORDER BY run_elapsed_seconds, event_sequence) AS nth,
         count(*) OVER (PARTITION BY run_id, item_id) AS repeats
  FROM picks
),
first_picks AS (
  SELECT run_id, game_version, choice_source, item_id, rarity, run_elapsed_seconds AS first_selected_at_seconds,
         cast(floor(run_elapsed_seconds / 60) as bigint) AS selection_minute, repeats AS selection_count_in_run
  FROM numbered_picks WHERE nth = 1
),
pick_outcomes AS (
  SELECT f.*, q.is_ended, q.end_reason, q.final_level, q.total_kills,
    CASE WHEN q.is_ended THEN greatest(q.run_duration_seconds - f.first_selected_at_seconds, 0) END AS remaining
  FROM first_picks f JOIN product q USING (run_id)
),
upgrade_post_selection AS (
  SELECT game_version, choice_source, item_id, rarity, selection_minute,
    {big('sum(selection_count_in_run)')} AS selection_count, count(*) AS selected_run_count,
    cast(count_if(is_ended) as bigint) AS outcome_observed_run_count,
    {mean('remaining')} AS average_seconds_after_selection,
    cast(count_if(is_ended AND end_reason = 'player_death' AND remaining <= 60) as bigint) AS death_within_60_seconds_count,
    {share("count_if(is_ended AND end_reason = 'player_death' AND remaining <= 60)", 'count_if(is_ended)')}
      AS death_within_60_seconds_percentage,
    {mean('final_level', 'is_ended')} AS average_final_level, {mean('total_kills', 'is_ended')} AS average_total_kills,
    {STATUS.format('count_if(is_ended)')} AS analysis_status
  FROM pick_outcomes GROUP BY ALL
),
item_totals AS (
  SELECT game_version, choice_source, item_id, {big('sum(selection_count)')} AS selection_count,
    {big('sum(selected_run_count)')} AS selected_run_count,
    {big('sum(outcome_observed_run_count)')} AS outcome_observed_run_count,
    {_weighted('average_seconds_after_selection')} AS average_seconds_after_selection,
    {big('sum(death_within_60_seconds_count)')} AS death_within_60_seconds_count,
    {share('sum(death_within_60_seconds_count)', 'sum(outcome_observed_run_count)')}
      AS death_within_60_seconds_percentage,
    {_weighted('average_final_level')} AS average_final_level, {_weighted('average_total_kills')} AS average_total_kills,
    {STATUS.format('sum(outcome_observed_run_count)')} AS analysis_status
  FROM upgrade_post_selection GROUP BY ALL
),
item_performance AS (
  SELECT t.*, c.display_name, c.item_category, c.intended_effect, c.primary_metric, c.rarity_scaled, c.metric_readiness
  FROM item_totals t LEFT JOIN catalog c USING (game_version, choice_source, item_id)
),
weapon_popularity AS (
  SELECT w.game_version, w.item_id AS weapon_id, w.display_name,
    (SELECT count(*) FROM product q WHERE q.is_started AND q.game_version = w.game_version
       AND q.starting_weapon_id = w.item_id) AS starting_run_count,
    coalesce(o.n, 0) AS exposure_count, coalesce(o.runs, 0) AS exposed_run_count,
    coalesce(s.n, 0) AS selection_count, coalesce(s.runs, 0) AS selected_run_count,
    {big('coalesce(s.firsts, 0)')} AS first_selected_run_count,
    {share('coalesce(s.n, 0)', 'coalesce(o.n, 0)')} AS selection_percentage
  FROM catalog w
  LEFT JOIN (SELECT game_version, item_id, count(*) AS n, count(DISTINCT run_id) AS runs FROM offers
             WHERE choice_source = 'level_up_weapon' GROUP BY ALL) o USING (game_version, item_id)
  LEFT JOIN (SELECT game_version, item_id, count(*) AS n, count(DISTINCT run_id) AS runs, cast(count_if(nth = 1) as bigint) AS firsts
             FROM (SELECT picks.*, row_number() OVER (PARTITION BY run_id ORDER BY event_sequence) AS nth
                   FROM picks WHERE choice_source = 'level_up_weapon')
             GROUP BY ALL) s USING (game_version, item_id)
  WHERE w.item_category = 'weapon'
),
weapon_performance AS (
  SELECT q.game_version, q.starting_weapon_id AS weapon_id, c.display_name, count(*) AS run_count,
    cast(count_if(is_ended) as bigint) AS outcome_observed_run_count,
    {mean('run_duration_seconds', 'is_ended')} AS average_run_seconds,
    {mean('total_kills', 'is_ended')} AS average_total_kills,
    {cents(f"60000000 * coalesce(sum(CASE WHEN is_ended THEN total_kills END), 0)",
           f"coalesce(sum(CASE WHEN is_ended THEN {micro('run_duration_seconds')} END), 0)")} AS kills_per_minute,
    {mean('final_level', 'is_ended')} AS average_final_level,
    {mean('total_xp_collected', 'is_ended')} AS average_total_xp,
    {mean('total_gold_collected', 'is_ended')} AS average_total_gold,
    {share("count_if(is_ended AND end_reason = 'player_death')", 'count_if(is_ended)')} AS death_percentage,
    {STATUS.format('count_if(is_ended)')} AS analysis_status
  FROM product q LEFT JOIN catalog c ON c.game_version = q.game_version AND c.choice_source = 'level_up_weapon'
    AND c.item_id = q.starting_weapon_id
  WHERE q.is_started AND q.starting_weapon_id IS NOT NULL GROUP BY ALL
),
observed AS (
  SELECT o.*, (o.run_id, o.choice_source, o.item_id) IN (SELECT (run_id, choice_source, item_id) FROM picks) AS picked,
         q.is_ended, q.total_kills, q.run_duration_seconds
  FROM (SELECT DISTINCT run_id, game_version, choice_source, item_id FROM offers) o JOIN product q USING (run_id)
),
option_outcomes AS (
  SELECT o.game_version, o.choice_source, o.item_id, c.display_name, c.item_category,
    count(*) AS offered_run_count, cast(count_if(picked) as bigint) AS selected_run_count, cast(count_if(NOT picked) as bigint) AS not_selected_run_count,
    cast(count_if({picked}) as bigint) AS selected_outcome_run_count, cast(count_if({rest}) as bigint) AS not_selected_outcome_run_count,
    {mean('total_kills', picked)} AS selected_average_kills, {mean('total_kills', rest)} AS not_selected_average_kills,
    {diff('total_kills')} AS average_kill_difference,
    {mean('run_duration_seconds', picked)} AS selected_average_run_seconds,
    {mean('run_duration_seconds', rest)} AS not_selected_average_run_seconds,
    {diff('run_duration_seconds')} AS average_run_seconds_difference,
    CASE WHEN count_if({picked}) < 30 OR count_if({rest}) < 30 THEN 'INSUFFICIENT_SAMPLE' ELSE 'DESCRIPTIVE_ONLY' END
      AS analysis_status
  FROM observed o LEFT JOIN catalog c USING (game_version, choice_source, item_id)
  GROUP BY ALL
),
funnel AS (
  SELECT o.choice_source, o.item_id, o.rarity, count(*) AS exposure_count, count(s.item_id) AS selection_count,
    {share('count(s.item_id)', 'count(*)')} AS selection_percentage
  FROM offers o LEFT JOIN picks s ON s.run_id = o.run_id AND s.choice_id = o.choice_id AND s.item_id = o.item_id
  GROUP BY ALL
)"""


def _weighted(column: str) -> str:
    return cents(
        f"sum(cast(round(coalesce({column}, 0) * 100) as hugeint) * outcome_observed_run_count)",
        "100 * sum(outcome_observed_run_count)",
    )


RUN_COLUMNS = """run_id, strftime(received_date, '%Y-%m-%d') AS received_date, source_type, game_version, run_status,
  is_started, is_ended,
  strftime(make_timestamp(first_us), '%Y-%m-%d %H:%M:%S.%f') AS first_received_at,
  strftime(make_timestamp(last_us), '%Y-%m-%d %H:%M:%S.%f') AS last_received_at,
  observed_run_seconds, run_duration_seconds, max_event_sequence, map_id, starting_weapon_id, starting_max_hp,
  end_reason, death_cause, cast(final_level as bigint) AS final_level, cast(total_kills as bigint) AS total_kills,
  total_xp_collected, current_gold, total_gold_collected, cast(hearts_collected as bigint) AS hearts_collected,
  cast(NULL as double) AS total_healing_received, cast(NULL as bigint) AS magnets_collected,
  cast(NULL as bigint) AS miniboss_waves_reached, cast(NULL as bigint) AS miniboss_waves_cleared,
  cast(final_upgrade_count as bigint) AS final_upgrade_count, final_upgrades_json, checkpoint_count,
  highest_checkpoint_number, upgrade_shown_count, upgrade_selected_count,
  cast(greatest(upgrade_shown_count - upgrade_selected_count, 0) as bigint) AS unselected_upgrade_count,
  cast(unique_event_count + exact_retry_count + conflicting_duplicate_count as bigint) AS input_event_count,
  cast(unique_event_count as bigint) AS unique_event_count, cast(exact_retry_count as bigint) AS exact_retry_count,
  cast(conflicting_duplicate_count as bigint) AS conflicting_duplicate_count,
  cast(quality_issue_count as bigint) AS quality_issue_count"""


def select(body: str) -> str:
    return f"{base()}\nSELECT {body}"
