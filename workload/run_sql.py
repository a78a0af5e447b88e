"""Check SQL for deliveries, event checks and sequence rules: window functions over the typed deliveries."""

from __future__ import annotations

from runtrace import contract
from workload.projection import DUCKDB, VERSIONS, deliveries_sql

_COUNTERS = ["run_elapsed_seconds", "total_kills", "total_xp_collected", "total_gold_collected", "hearts_collected"]
_DAY_US = 24 * 3600 * 1_000_000


def _issue(code: str, path: str, event_id: str = "event_id", copies: str = "1") -> str:
    return f"run_id, '{code}' AS code, {event_id} AS event_id, '{path}' AS path, cast({copies} as bigint) AS copies"


def _counter_parts() -> str:
    return " UNION ALL ".join(
        f"SELECT {_issue(contract.COUNTER_DECREASED, c)} FROM scanned WHERE {c} < prev_{c}" for c in _COUNTERS
    )


def _correlation_parts() -> str:
    return " UNION ALL ".join(
        f"SELECT {_issue(contract.CORRELATION_MISMATCH, c)} FROM scanned WHERE {c} IS DISTINCT FROM ref.{c}"
        for c in ("game_version", "schema_version", "source_type")
    )


def base() -> str:
    previous = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER earlier AS prev_{c}" for c in _COUNTERS
    )
    order, mismatch = contract.EVENT_ORDER_INVALID, contract.CHOICE_MISMATCH
    return f"""WITH {deliveries_sql(DUCKDB)},
bodies AS (
  SELECT * EXCLUDE nth FROM (
    SELECT d.*, count(*) OVER same AS copies, row_number() OVER (same ORDER BY received_us) AS nth
    FROM deliveries d WINDOW same AS (PARTITION BY run_id, event_id, body))
  WHERE nth = 1
),
uniq AS (
  SELECT * EXCLUDE nth, copies - 1 AS retries, arrivals - copies AS conflicts FROM (
    SELECT b.*, sum(copies) OVER (PARTITION BY run_id, event_id) AS arrivals,
           row_number() OVER (PARTITION BY run_id, event_id ORDER BY received_us) AS nth FROM bodies b)
  WHERE nth = 1
),
claimed AS (
  SELECT u.*, row_number() OVER (PARTITION BY run_id, event_sequence ORDER BY received_us) AS claim FROM uniq u
),
ordered AS (SELECT * FROM claimed WHERE claim = 1),
facts AS (
  SELECT run_id, min(event_sequence) AS first_at,
    min(event_sequence) FILTER (event_name = 'run_started') AS start_at,
    min(event_sequence) FILTER (event_name = 'run_ended') AS end_at,
    coalesce(arg_min({{'game_version': game_version, 'schema_version': schema_version, 'source_type': source_type}},
                     event_sequence) FILTER (event_name = 'run_started'),
             arg_min({{'game_version': game_version, 'schema_version': schema_version, 'source_type': source_type}},
                     event_sequence)) AS ref
  FROM ordered GROUP BY run_id
),
scanned AS (
  SELECT o.*, f.first_at, f.start_at, f.end_at, f.ref, {previous},
    lag(event_sequence, 1, 0) OVER (PARTITION BY o.run_id ORDER BY event_sequence) AS prev_sequence,
    last_value(CASE WHEN event_name = 'upgrade_options_shown' THEN choice_sequence END IGNORE NULLS) OVER earlier
      AS prev_choice,
    last_value(CASE WHEN event_name = 'run_checkpoint' THEN checkpoint_number END IGNORE NULLS) OVER earlier
      AS prev_checkpoint
  FROM ordered o JOIN facts f USING (run_id)
  WINDOW earlier AS (PARTITION BY o.run_id ORDER BY event_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
shown_first AS (
  SELECT * FROM (SELECT o.*, row_number() OVER (PARTITION BY run_id, choice_id ORDER BY event_sequence) AS nth
                 FROM ordered o WHERE event_name = 'upgrade_options_shown') WHERE nth = 1
),
event_issues AS (
  SELECT {_issue(contract.PROHIBITED_FIELD, 'context/items/0/Device-Id', copies='copies')} FROM bodies
  WHERE has_device_id = 1
  UNION ALL
  SELECT {_issue(contract.SCHEMA_INVALID, '', copies='copies')} FROM bodies
  WHERE has_device_id = 0 AND has_unknown_key = 1
  UNION ALL
  SELECT {_issue(contract.SCHEMA_INVALID, 'options', copies='copies')} FROM bodies
  WHERE has_device_id = 0 AND event_name = 'upgrade_options_shown' AND rarity_1 = 'mythic'
  UNION ALL
  SELECT {_issue(mismatch, 'options', copies='copies')} FROM bodies
  WHERE has_device_id = 0 AND has_unknown_key = 0 AND rarity_1 <> 'mythic'
    AND event_name = 'upgrade_options_shown' AND item_3 IS NOT NULL AND item_1 = item_2
),
duplicate_conflict AS (
  SELECT {_issue(contract.DUPLICATE_CONFLICT, 'event_id', copies='conflicts')} FROM uniq WHERE conflicts > 0
),
seq_conflict AS (SELECT {_issue(contract.EVENT_SEQUENCE_CONFLICT, 'event_sequence')} FROM claimed WHERE claim > 1),
seq_gap AS (
  SELECT {_issue(contract.EVENT_SEQUENCE_GAP, 'event_sequence')} FROM scanned WHERE event_sequence > prev_sequence + 1
),
run_boundary AS (
  SELECT {_issue(contract.MISSING_RUN_START, '', 'NULL')} FROM facts WHERE start_at IS NULL
  UNION ALL SELECT {_issue(contract.MISSING_RUN_END, '', 'NULL')} FROM facts WHERE end_at IS NULL
  UNION ALL SELECT {_issue(order, 'event_name')} FROM scanned
    WHERE event_name = 'run_started' AND event_sequence > start_at
  UNION ALL SELECT {_issue(order, 'event_name')} FROM scanned WHERE event_name = 'run_ended' AND event_sequence > end_at
),
correlation AS ({_correlation_parts()}),
before_start AS (
  SELECT {_issue(order, 'event_sequence')} FROM scanned
  WHERE event_sequence < start_at AND NOT (event_name IN ('upgrade_options_shown', 'upgrade_selected')
    AND choice_source = 'level_up_weapon' AND run_elapsed_seconds = 0)
),
after_end AS (SELECT {_issue(order, 'event_sequence')} FROM scanned WHERE event_sequence > end_at),
choice_order AS (
  SELECT {_issue(contract.COUNTER_DECREASED, 'choice_sequence')} FROM scanned
  WHERE event_name = 'upgrade_options_shown' AND choice_sequence <= coalesce(prev_choice, 0)
),
checkpoint_rules AS (
  SELECT {_issue(contract.COUNTER_DECREASED, 'checkpoint_number')} FROM scanned
  WHERE event_name = 'run_checkpoint' AND checkpoint_number <= coalesce(prev_checkpoint, 0)
  UNION ALL SELECT {_issue(order, 'run_elapsed_seconds')} FROM scanned
  WHERE event_name = 'run_checkpoint' AND run_elapsed_seconds <> 60 * checkpoint_number
),
counter_decreased AS ({_counter_parts()}),
choice_reuse AS (
  SELECT o.run_id, '{mismatch}' AS code, o.event_id, 'choice_id' AS path, cast(1 as bigint) AS copies
  FROM ordered o JOIN shown_first s USING (run_id, choice_id)
  WHERE o.event_name = 'upgrade_options_shown' AND o.event_id <> s.event_id
),
linked AS (
  SELECT o.*, s.event_id AS shown_id, s.event_sequence AS shown_at, s.choice_sequence AS shown_sequence,
    s.choice_source AS shown_source,
    CASE o.selected_slot WHEN 1 THEN s.item_1 WHEN 2 THEN s.item_2 ELSE s.item_3 END AS shown_item,
    CASE o.selected_slot WHEN 1 THEN s.rarity_1 WHEN 2 THEN s.rarity_2 ELSE s.rarity_3 END AS shown_rarity
  FROM ordered o LEFT JOIN shown_first s USING (run_id, choice_id) WHERE o.event_name = 'upgrade_selected'
),
choice_linkage AS (
  SELECT {_issue(contract.CHOICE_NOT_FOUND, 'choice_id')} FROM linked WHERE shown_id IS NULL
  UNION ALL SELECT {_issue(order, 'event_sequence')} FROM linked WHERE shown_at >= event_sequence
  UNION ALL SELECT {_issue(mismatch, 'choice_id')} FROM linked WHERE shown_id IS NOT NULL AND (
    selected_item_id IS DISTINCT FROM shown_item OR selected_rarity IS DISTINCT FROM shown_rarity
    OR choice_sequence <> shown_sequence OR choice_source <> shown_source)
),
cross_run_conflict AS (
  SELECT {_issue(contract.DUPLICATE_CONFLICT, 'event_id')} FROM uniq
  WHERE event_id IN (SELECT event_id FROM uniq GROUP BY event_id HAVING count(DISTINCT run_id) > 1)
),
late_event AS (
  SELECT {_issue(contract.EVENT_ARRIVAL_TOO_LATE, 'metadata/received_at')}
  FROM (SELECT u.*, min(received_us) OVER (PARTITION BY run_id) AS opened FROM uniq u)
  WHERE received_us > opened + {_DAY_US}
),
sequence_issues AS (
  SELECT * FROM duplicate_conflict UNION ALL SELECT * FROM seq_conflict UNION ALL SELECT * FROM seq_gap
  UNION ALL SELECT * FROM run_boundary UNION ALL SELECT * FROM correlation UNION ALL SELECT * FROM before_start
  UNION ALL SELECT * FROM after_end UNION ALL SELECT * FROM choice_order UNION ALL SELECT * FROM checkpoint_rules
  UNION ALL SELECT * FROM counter_decreased UNION ALL SELECT * FROM choice_reuse UNION ALL SELECT * FROM choice_linkage
),
issues AS (
  SELECT * FROM event_issues
  UNION ALL SELECT * FROM sequence_issues WHERE run_id NOT IN (SELECT run_id FROM event_issues)
  UNION ALL SELECT * FROM cross_run_conflict UNION ALL SELECT * FROM late_event
),
issue_totals AS (
  SELECT run_id, sum(copies) AS n, bool_or(code NOT IN {contract.INCOMPLETE_CODES}) AS breaking
  FROM issues GROUP BY run_id
),
runs AS (
  SELECT u.run_id, min(received_us) AS opened_us, arg_min(source_type, event_sequence * 1000000000000000000::hugeint + received_us) AS source_type,
    cast(sum(retries + conflicts + 1) as bigint) AS input_event_count, count(*) AS unique_event_count,
    cast(sum(retries) as bigint) AS exact_retry_count, cast(sum(conflicts) as bigint) AS conflicting_duplicate_count,
    cast(coalesce(max(i.n), 0) as bigint) AS quality_issue_count,
    CASE WHEN max(i.n) IS NULL THEN 'valid' WHEN bool_or(i.breaking) THEN 'invalid' ELSE 'incomplete' END AS run_status
  FROM uniq u LEFT JOIN issue_totals i USING (run_id) GROUP BY u.run_id
)"""


def select(body: str) -> str:
    return f"{base()}\nSELECT {body}"


def day(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%d')"


def moment(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%d %H:%M:%S.%f')"
