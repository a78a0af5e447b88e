"""Queries from deliveries to Silver: Bronze, event checks, sequence rules, reconstruction, export and storage."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import functions as F

from runtrace import contract
from runtrace.operators import export, gold_runs, reconstruct as R, rekey, sequence
from runtrace.operators.reconstruct import utc_date
from runtrace.schemas import EXPORT, EXPORT_HEADER, GOLD
from runtrace.sources import bronze, imports, lake
from runtrace.sources.kept import keep_batch, keep_deliveries, kept, put_rejects
from runtrace.sources.staging import new_folder, stage
from runtrace.plans.run_date import rebuild_silver
from runtrace.streaming.ingest import rebuild_touched
from runtrace.streaming.runs import closed_runs, start_closing, start_dedup
from workload import gold_sql as S
from workload import run_sql as D
from workload.projection import (
    DUCKDB,
    bronze_folder,
    bronze_lines,
    event_json,
    lines_by_number,
    settle_session,
    silver,
    silver_rows,
    stored,
    telemetry,
    telemetry_sql,
)
from workload.registry import Query, comparable

# --- stored steps of the reconstruction ----------------------------------------------------------


def _opened(spark, sf_dir):
    settle_session(spark)
    return bronze.open_envelopes(bronze.scan_bronze(spark, bronze_folder(spark, sf_dir)))


def _deliveries(spark, sf_dir):
    path = stored(spark, sf_dir, "deliveries", lambda to: _opened(spark, sf_dir).write.parquet(to))
    settle_session(spark)
    return bronze.sound_deliveries(spark.read.parquet(path))


def _bodies(spark, sf_dir):
    return spark.read.parquet(stored(
        spark, sf_dir, "bodies", lambda to: R.distinct_bodies(_deliveries(spark, sf_dir)).write.parquet(to)))


def _unique(spark, sf_dir):
    return spark.read.parquet(stored(
        spark, sf_dir, "events", lambda to: R.unique_events(_bodies(spark, sf_dir)).write.parquet(to)))


def _members(spark, sf_dir):
    return sequence.typed_events(_unique(spark, sf_dir))


def _ordered(spark, sf_dir):
    return spark.read.parquet(stored(
        spark, sf_dir, "ordered", lambda to: sequence.ordered_events(_unique(spark, sf_dir)).drop("event_json").write.parquet(to)))


def _scanned(spark, sf_dir):
    ordered = _ordered(spark, sf_dir)
    return sequence.scanned(ordered, ordered.agg(F.max("event_sequence")).first()[0])


def _issue_view(issues):
    return issues.select("run_id", "code", "event_id", F.concat_ws("/", "path").alias("path"), "copies")


def _rule(rule: str, source) -> Query:
    """One rule's issues over all ordered events, whatever else is wrong with their runs."""
    return Query(
        lambda spark, sf_dir: _issue_view(source(spark, sf_dir).where(F.col("rule") == rule)),
        D.select(f"* FROM {rule}"),
    )


def _order_rule(rule: str) -> Query:
    return _rule(rule, lambda spark, sf_dir: sequence.order_issues(_scanned(spark, sf_dir)))


def _validated(where, sql_where: str) -> Query:
    return Query(
        lambda spark, sf_dir: _issue_view(R.event_issues(_bodies(spark, sf_dir)).where(where)),
        D.select(f"* FROM event_issues WHERE {sql_where}"),
    )


# --- Bronze --------------------------------------------------------------------------------------


def _bronze_scan(spark, sf_dir):
    """Deliveries per run as read back from the stored lines."""
    return comparable(
        _opened(spark, sf_dir).groupBy("run_id").agg(
            F.count("*").alias("deliveries"), F.min("received_at").alias("first_received_at"),
            F.max("received_at").alias("last_received_at"), F.count_distinct("event_id").alias("event_ids"))
    )


def _bronze_envelope(spark, sf_dir):
    events = telemetry(spark, sf_dir).withColumn("event", F.parse_json(event_json()))
    records = bronze.envelopes(events, F.timestamp_micros("us"))
    return records.select(
        "bronze_record_version",
        F.try_variant_get("event", "$.event_id", "string").alias("event_id"),
        F.col("metadata.received_at").alias("received_at"),
        F.col("metadata.ingestion_channel").alias("ingestion_channel"),
    )


_ENVELOPE_FAULTS = {
    0: ("unsupported_version", lambda v: F.replace(v, F.lit('_version":1'), F.lit('_version":2'))),
    1: ("record_not_an_object", lambda v: F.concat(F.lit("["), v, F.lit("]"))),
    2: ("record_not_an_object", lambda v: F.substring(v, F.lit(1), F.length(v) - 1)),
    3: ("no_event_object", lambda v: F.replace(v, F.lit('"event":{'), F.lit('"evt":{'))),
    4: ("invalid_received_at", lambda v: F.regexp_replace(v, r'(\d)Z","ingestion', r'$1","ingestion')),
    5: ("invalid_metadata", lambda v: F.replace(v, F.lit('"ingestion_channel":'), F.lit('"channel":'))),
    6: ("no_run_or_event_id", lambda v: F.replace(v, F.lit('"run_id":"'), F.lit('"run":"'))),
    7: ("no_metadata_object", lambda v: F.replace(v, F.lit('"metadata":{'), F.lit('"meta":{'))),
}


def _envelope_check(spark, sf_dir):
    opened = bronze.open_envelopes(_faulty_lines(spark, sf_dir))
    return opened.groupBy(F.coalesce("envelope_error", F.lit("sound")).alias("outcome")).agg(
        F.count("*").alias("records"))


def _envelope_sql() -> str:
    cases = " ".join(f"WHEN {slot} THEN '{error}'" for slot, (error, _) in _ENVELOPE_FAULTS.items())
    return D.select(f"CASE n % 50 {cases} ELSE 'sound' END AS outcome, count(*) AS records FROM deliveries GROUP BY 1")


def _faulty_lines(spark, sf_dir):
    lines = lines_by_number(spark, sf_dir)
    value = F.col("value")
    for slot, (_, broken) in _ENVELOPE_FAULTS.items():
        value = F.when(F.col("n") % 50 == slot, broken(F.col("value"))).otherwise(value)
    return lines.select(value.alias("value"), "received_date")


def _bronze_rejects(spark, sf_dir):
    """Broken records as they are listed by reason and day, and the sound ones beside them."""
    base = new_folder(spark, "lake")
    opened = stage(bronze.open_envelopes(stage(_faulty_lines(spark, sf_dir), "lines")), "opened")
    put_rejects(opened, base, 0)
    listed = lake.read_rejects(spark, base).groupBy("reason", "received_date").agg(
        F.count("*").alias("records"), F.count_if(F.length("line_sha256") == 64).alias("digests"))
    sound = bronze.sound_deliveries(opened).select(F.lit("accepted").alias("reason"), utc_date(F.col("received_at")).alias("received_date"))
    accepted = sound.groupBy("reason", "received_date").agg(F.count("*").alias("records"), F.lit(0).cast("bigint").alias("digests"))
    return comparable(listed.unionByName(accepted))


_REJECTS_SQL = D.select(f"""reason, received_date, count(*) AS records, count(*) FILTER (reason <> 'accepted') AS digests FROM (
  SELECT CASE n % 50 {' '.join(f"WHEN {slot} THEN '{error}'" for slot, (error, _) in _ENVELOPE_FAULTS.items())} ELSE 'accepted' END AS reason,
    {D.day('received_us')} AS received_date FROM deliveries) GROUP BY ALL""")


def _lake_rows(spark, base):
    """What is stored of Silver and quarantine, row by row."""
    parts = [
        lake.read_table(spark, base, table).select("run_id", "event_id", "run_status", "quality_issue_count",
                                                   "received_date", F.lit(table).alias("target"))
        for table in ("silver", "quarantine")
    ]
    return comparable(parts[0].unionByName(parts[1]))


def _rebuild_incremental(spark, sf_dir):
    """Bronze that arrives in two parts, each followed by the batch of a stream; then the whole lake."""
    base, lines = new_folder(spark, "lake"), stage(bronze_lines(spark, sf_dir), "lines", "received_date")
    for number, part in enumerate(_PARTS):
        rebuild_touched(lines.where(part), number, base)
    return _lake_rows(spark, base)


_PARTS = ("received_date < DATE '2024-01-16'", "received_date >= DATE '2024-01-16'")
_HELD = 97  # every so many rows reach the stream after all others
_LATE_SQL = f"""n % {_HELD} = 0 AND received_us // 1000 < (SELECT max(received_us) FROM deliveries WHERE n % {_HELD} <> 0) // 1000 - 86400000"""


def _stream_dedup(spark, sf_dir):
    """Bronze files that arrive out of order, in three rounds of one stream; deliveries of each run by their route."""
    path, checkpoint, bronze_path = (new_folder(spark, name) for name in ("routed", "dedup", "bronze"))
    lines = stage(lines_by_number(spark, sf_dir), "lines")
    held = F.col("n") % _HELD == 0
    for some in [lines.where(part).where(~held) for part in _PARTS] + [lines.where(held)]:
        some.drop("n").write.mode("append").partitionBy("received_date").option("compression", "gzip").text(bronze_path)
        start_dedup(spark, bronze_path, path, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(path).groupBy("run_id", "route").agg(F.count("*").alias("deliveries"))


def _stream_run_close(spark, sf_dir):
    """Statuses of the runs whose time is over, from a stream that stops and goes on between two batches of deliveries."""
    base, checkpoint, lines = new_folder(spark, "lake"), new_folder(spark, "closing"), bronze_lines(spark, sf_dir)
    for number, part in enumerate(_PARTS):
        keep_batch(stage(lines.where(part), "lines"), number, base)
        start_closing(spark, base, checkpoint, available_now=True).awaitTermination()
    return comparable(closed_runs(spark, base))


def _gold_from_bronze(spark, sf_dir):
    """Run quality and outcomes of rebuilt Silver: from lines to Gold."""
    trusted, _ = lake.split_by_trust(_rebuilt(spark, sf_dir))
    quality = gold_runs.run_quality(trusted).select(
        F.lit("run_status").alias("kind"), F.col("run_status").alias("name"), F.col("run_count").alias("runs"),
        F.col("unique_event_count").alias("amount"))
    outcome = gold_runs.run_outcome(trusted).select(
        F.lit("end_reason").alias("kind"), F.col("end_reason").alias("name"), F.col("ended_run_count").alias("runs"),
        F.col("average_run_seconds").alias("amount"))
    return comparable(quality.withColumn("amount", F.col("amount").cast("double")).unionByName(
        outcome.withColumn("amount", F.col("amount").cast("double"))))


_GOLD_FROM_BRONZE_SQL = D.select(f"""'run_status' AS kind, run_status AS name, count(*) AS runs, cast(sum(unique_event_count) as double) AS amount
FROM runs WHERE run_status <> 'invalid' GROUP BY run_status
UNION ALL
SELECT 'end_reason', end_reason, count(*), cast({S.mean('u.run_elapsed_seconds')} as double)
FROM uniq u JOIN runs q USING (run_id)
WHERE q.run_status <> 'invalid' AND q.source_type = 'CONSENTED_PROD_PLAY' AND u.event_name = 'run_ended' GROUP BY end_reason""")


def _faulty_channel():
    """Every 13th event claims another channel, every 17th one nobody knows."""
    return F.when(F.col("n") % 13 == 0, "scenario_generator").when(F.col("n") % 17 == 0, "carrier_pigeon").otherwise(
        F.col("ingestion_channel"))


_CHANNEL_SQL = ("CASE WHEN n % 13 = 0 THEN 'scenario_generator' WHEN n % 17 = 0 THEN 'carrier_pigeon' "
                "ELSE ingestion_channel END")
_ALLOWED_SQL = " OR ".join(f"(channel = '{c}' AND source_type = '{s}')" for c, s in contract.CHANNEL_SOURCES)


def _channel_policy(spark, sf_dir):
    rows = telemetry(spark, sf_dir).withColumn("channel", _faulty_channel())
    return rows.select(
        "event_id", "channel", "source_type",
        bronze.channel_allows(F.col("channel"), F.col("source_type")).alias("allowed"))


def _requests(spark, sf_dir):
    return spark.read.parquet(stored(
        spark, sf_dir, "requests", lambda to: _request_rows(spark, sf_dir).write.parquet(to)))


def _request_rows(spark, sf_dir):
    """Request bodies, some of them encoded, broken, oversized or absent."""
    events = telemetry(spark, sf_dir, faults=True)
    body, case, n = event_json(), F.col("n") % 20, F.col("n")
    text = (
        F.when(n % 1000 == 4, F.rpad(body, contract.MAX_BODY_BYTES + 1, " "))
        .when(case == 1, F.base64(body.cast("binary")))
        .when(case == 2, F.lit("*not base64*"))
        .when(case == 3, F.substring(body, F.lit(1), F.length(body) - 2))
        .when(case == 5, F.lit(None))
        .otherwise(body)
    )
    return events.select(
        "n", text.alias("body"), case.isin(1, 2).alias("is_base64"), _faulty_channel().alias("ingestion_channel"))


_BODY_SQL = (
    "CASE WHEN n % 1000 = 4 THEN 'body_too_large' WHEN n % 20 = 5 THEN 'body_missing' "
    "WHEN n % 20 = 2 THEN 'invalid_base64' WHEN n % 20 = 3 THEN 'invalid_json' END"
)


def _body_checks(spark, sf_dir):
    return bronze.read_bodies(_requests(spark, sf_dir)).select("n", "body_error")


def _ingest_split(spark, sf_dir):
    accepted, rejected = bronze.split_ingest(_requests(spark, sf_dir).drop("n"))
    both = accepted.select(F.lit("accepted").alias("reason")).unionByName(rejected.select("reason"))
    return both.groupBy("reason").agg(F.count("*").alias("requests"))


def _faulty(prefix: str = "") -> str:
    return f"WITH {telemetry_sql(DUCKDB, faults=True)}{prefix}"


_INGEST_SQL = _faulty(f""",
rated AS (
  SELECT {_BODY_SQL} AS body_error, {_CHANNEL_SQL} AS channel, source_type,
    CASE WHEN has_device_id = 1 THEN 'prohibited_field'
         WHEN has_unknown_key = 1 OR (event_name = 'upgrade_options_shown' AND rarity_1 = 'mythic')
           THEN 'schema_invalid'
         WHEN event_name = 'upgrade_options_shown' AND item_3 IS NOT NULL AND item_1 = item_2 THEN 'choice_mismatch'
    END AS event_error
  FROM telemetry)
SELECT CASE WHEN body_error IS NOT NULL THEN body_error WHEN event_error IS NOT NULL THEN event_error
            WHEN channel = 'carrier_pigeon' THEN 'unsupported_channel'
            WHEN NOT ({_ALLOWED_SQL}) THEN 'source_not_allowed' ELSE 'accepted' END AS reason, count(*) AS requests
FROM rated GROUP BY 1""")


# --- reconstruction ------------------------------------------------------------------------------


def _dedup_earliest(spark, sf_dir):
    return comparable(_unique(spark, sf_dir).select(
        "run_id", "event_id", "event_sequence", "first_received_at", "ingestion_channel", "retries", "conflicts"))


def _dedup_counts(spark, sf_dir):
    none = _unique(spark, sf_dir).limit(0).select("run_id", F.lit("").alias("code"), F.lit(1).alias("copies"))
    return R.run_rows(_unique(spark, sf_dir), none).select(
        "run_id", "source_type", "input_event_count", "unique_event_count", "exact_retry_count",
        "conflicting_duplicate_count")


def _run_status(spark, sf_dir):
    runs = R.reconstruct(_deliveries(spark, sf_dir)).runs
    return comparable(runs.select(
        "run_id", "source_type", "run_status", "received_date", "input_event_count", "unique_event_count",
        "exact_retry_count", "conflicting_duplicate_count", "quality_issue_count"))


_RUN_COLUMNS = f"""run_id, source_type, run_status, {D.day('opened_us')} AS received_date, input_event_count,
  unique_event_count, exact_retry_count, conflicting_duplicate_count, quality_issue_count"""


def _rebuilt(spark, sf_dir):
    """Silver rows of every run, rebuilt from the stored lines."""
    return spark.read.parquet(stored(
        spark, sf_dir, "rebuilt",
        lambda to: R.silver_rows(R.reconstruct(_deliveries(spark, sf_dir))).write.parquet(to)))


def _silver_rows(spark, sf_dir):
    rows = _rebuilt(spark, sf_dir)
    member = lambda name: F.get_json_object("event_payload_json", f"$.{name}")
    return comparable(rows.select(
        "run_id", "event_id", "event_name", "event_sequence", "run_elapsed_seconds", "source_type", "game_version",
        "schema_version", "run_status", "first_received_at", "ingestion_channel", "input_event_count",
        "unique_event_count", "exact_retry_count", "conflicting_duplicate_count", "quality_issue_count",
        "received_date",
        "quality_issues_json",
        member("choice_id").alias("choice_id"), member("total_kills").cast("bigint").alias("total_kills"),
        member("end_reason").alias("end_reason"), member("run_id").alias("common_field")))


#: Place in a run's list and message of each rule's issues; `u` is the event, `before` the sequence number ahead of it.
_LISTED = {
    "event_issues": ("0", f"""CASE WHEN code = '{contract.PROHIBITED_FIELD}' THEN 'prohibited direct-identifier field: Device-Id'
      WHEN code = '{contract.CHOICE_MISMATCH}' THEN 'statue options must use distinct item_id values'
      WHEN path = 'options' THEN 'options must be a valid options' ELSE 'unreviewed_metric is not part of the contract' END"""),
    "duplicate_conflict": ("1", "'the same event_id was delivered with different content'"),
    "seq_conflict": ("2", "'different events use the same event_sequence'"),
    "seq_gap": ("3", "'missing event_sequence values between ' || before || ' and ' || u.event_sequence"),
    "run_boundary": (
        f"CASE WHEN code = '{contract.MISSING_RUN_START}' OR u.event_name = 'run_started' THEN 4 ELSE 5 END",
        f"""'the sequence contains ' || CASE code WHEN '{contract.MISSING_RUN_START}' THEN 'no run_started event'
      WHEN '{contract.MISSING_RUN_END}' THEN 'no run_ended event' ELSE 'more than one ' || u.event_name || ' event' END"""),
    "correlation": ("6", "path || ' does not match the run'"),
    "before_start": ("7", "'only a zero-time initial weapon choice may precede run_started'"),
    "choice_reuse": ("8", "'the same choice_id identifies different shown choices'"),
    "after_end": ("9", "'an event occurs after run_ended in run order'"),
    "choice_order": ("9", "'choice_sequence must strictly increase for shown choices'"),
    "checkpoint_rules": ("9", """CASE path WHEN 'checkpoint_number' THEN 'checkpoint_number must strictly increase'
      ELSE 'run_elapsed_seconds must equal checkpoint_number multiplied by 60' END"""),
    "counter_decreased": ("9", "path || ' decreased within the run'"),
    "choice_linkage": ("9", f"""CASE code WHEN '{contract.CHOICE_NOT_FOUND}' THEN 'no upgrade_options_shown uses this choice_id'
      WHEN '{contract.EVENT_ORDER_INVALID}' THEN 'upgrade_selected must follow upgrade_options_shown'
      ELSE 'selected upgrade does not match the linked options' END"""),
    "cross_run_conflict": ("10", "'the same event_id is used by different runs'"),
    "late_event": ("11", "'event arrived after the lateness window'"),
}
_ALONE = ("event_issues", "cross_run_conflict", "late_event")  # listed whatever else is wrong with the run


def _listed(rule: str) -> str:
    place, message = _LISTED[rule]
    flawed = "" if rule in _ALONE else "WHERE i.run_id NOT IN (SELECT run_id FROM event_issues)"
    before = "LEFT JOIN (SELECT run_id, event_id, prev_sequence AS before FROM scanned) b USING (run_id, event_id)" if rule == "seq_gap" else ""
    sequence_of = "NULL" if rule in ("duplicate_conflict", "cross_run_conflict", "late_event") else "u.event_sequence"
    return f"""SELECT i.run_id, {place} AS place, {sequence_of} AS number, i.event_id, i.code, {message} AS message, i.path, i.copies
    FROM {rule} i LEFT JOIN uniq u USING (run_id, event_id) {before} {flawed}"""


_ENTRY = """'{"code":"' || code || '","event_id":' || coalesce('"' || event_id || '"', 'null') || ',"message":"' || message || '","path":[' ||
      CASE path WHEN '' THEN '' ELSE '"' || replace(path, '/', '","') || '"' END || ']}'"""

_SILVER_SQL = D.select(f"""u.run_id, u.event_id, u.event_name, u.event_sequence, u.run_elapsed_seconds, q.source_type,
  u.game_version, u.schema_version, q.run_status, {D.moment('u.received_us')} AS first_received_at,
  u.ingestion_channel, q.input_event_count, q.unique_event_count, q.exact_retry_count, q.conflicting_duplicate_count,
  q.quality_issue_count, {D.day('q.opened_us')} AS received_date, coalesce(l.list, '[]') AS quality_issues_json,
  u.choice_id, cast(u.total_kills as bigint) AS total_kills, u.end_reason, cast(NULL as varchar) AS common_field
  FROM uniq u JOIN runs q USING (run_id) LEFT JOIN (
    SELECT run_id, '[' || string_agg({_ENTRY}, ',' ORDER BY place, number NULLS FIRST, event_id NULLS FIRST, code, message, path) || ']' AS list
    FROM (SELECT *, unnest(range(copies)) AS copy FROM ({" UNION ALL ".join(_listed(rule) for rule in _LISTED)})) GROUP BY 1
  ) l USING (run_id)""")


def _split(spark, sf_dir):
    trusted, broken = lake.split_by_trust(_rebuilt(spark, sf_dir))
    both = trusted.withColumn("target", F.lit("silver")).unionByName(broken.withColumn("target", F.lit("quarantine")))
    return both.groupBy("target", "run_status").agg(
        F.count("*").alias("events"), F.count_distinct("run_id").alias("runs"))


_BACKFILL_DAY = "2024-01-10"


def _kept_lake(spark, sf_dir):
    """A lake whose Bronze lines were opened once."""
    def write(base):
        settle_session(spark)
        keep_deliveries(spark, bronze_folder(spark, sf_dir), base)

    return stored(spark, sf_dir, "kept-lake", write)


def _date_backfill(spark, sf_dir):
    """One date rebuilt from the kept deliveries into its folders and read back. Only new Bronze files would be opened."""
    base = _kept_lake(spark, sf_dir)
    rebuild_silver(spark, bronze_folder(spark, sf_dir), base, _BACKFILL_DAY)
    return _lake_rows(spark, base)


def _event_id_index(spark, sf_dir):
    """Issues of shared event ids, for the runs of all dates, from the index that two batches of deliveries left."""
    base, lines = new_folder(spark, "lake"), stage(bronze_lines(spark, sf_dir), "lines", "received_date")
    for number, part in enumerate(_PARTS):
        keep_batch(lines.where(part), number, base)
    state = kept(spark, base)
    bodies = state.bodies()
    return _issue_view(R.cross_run_issues(bodies.select("run_id", "event_id").distinct(), state.shared_event_ids(bodies)))


def _silver_sink(spark, sf_dir):
    folder = new_folder(spark, "sink")
    silver_rows(spark, sf_dir).write.option("compression", "snappy").partitionBy("received_date").parquet(
        f"{folder}/silver")
    rows = lake.read_table(spark, folder)
    return comparable(rows.groupBy("received_date", "event_name").agg(
        F.count("*").alias("events"), F.count_distinct("run_id").alias("runs")))


# --- export --------------------------------------------------------------------------------------


def _daily(function, sql: str) -> Query:
    return Query(lambda spark, sf_dir: comparable(function(silver(spark, sf_dir))),
                 f"WITH {telemetry_sql(DUCKDB)} SELECT strftime(day, '%Y-%m-%d') AS bucket_date, {sql}")


def _total(value: str) -> str:
    return f"cast(sum({S.micro(value)}) as double) / 1000000"


_EVENT_COUNTS = "event_name, count(*) AS count FROM telemetry GROUP BY ALL"
_SLOTS = " UNION ALL ".join(
    f"SELECT day, item_{i} AS item_id, rarity_{i} AS rarity, {i} AS slot FROM telemetry "
    f"WHERE event_name = 'upgrade_options_shown' AND item_{i} IS NOT NULL" for i in (1, 2, 3))
_ENDS = f"""end_reason, count(*) AS end_count, {_total('run_elapsed_seconds')} AS run_duration_seconds_sum,
  {S.big('sum(final_level)')} AS final_level_sum, {S.big('sum(total_kills)')} AS total_kills_sum,
  {_total('current_gold')} AS current_gold_sum FROM telemetry WHERE event_name = 'run_ended' GROUP BY ALL"""


def _documents(spark, sf_dir):
    return spark.read.parquet(stored(
        spark, sf_dir, "documents-1", lambda to: export.export_documents(silver(spark, sf_dir)).write.parquet(to)))


def _export_document(spark, sf_dir):
    documents = export.export_documents(silver(spark, sf_dir), revision=3)
    sizes = [F.size(f"metrics.{name}").cast("bigint").alias(name) for name in (
        "event_counts", "upgrade_option_counts", "upgrade_selected_counts", "run_checkpoint_counts", "run_end_counts")]
    return documents.select(
        *EXPORT_HEADER, *sizes,
        F.col("metrics.event_counts")[0]["event_name"].alias("first_event"),
        F.col("metrics.event_counts")[0]["count"].alias("first_count"))


_DOCUMENT_SQL = f"""WITH {telemetry_sql(DUCKDB)}, slots AS ({_SLOTS})
SELECT 'aggregate-export-v1' AS schema_version, strftime(t.day, '%Y-%m-%d') AS bucket_date, cast(3 as bigint) AS revision,
  'TR' AS source_region, 'ap-southeast-2' AS destination_region, 'aggregate_only' AS privacy_mode,
  'SYNTHETIC_TEST' AS data_class, count(DISTINCT event_name) AS event_counts,
  (SELECT count(DISTINCT (item_id, rarity, slot)) FROM slots s WHERE s.day = t.day) AS upgrade_option_counts,
  count(DISTINCT (selected_item_id, selected_rarity, selected_slot)) FILTER (event_name = 'upgrade_selected')
    AS upgrade_selected_counts,
  count(DISTINCT checkpoint_number) AS run_checkpoint_counts, count(DISTINCT end_reason) AS run_end_counts,
  min(event_name) AS first_event,
  (SELECT count(*) FROM telemetry f WHERE f.day = t.day AND f.event_name = min(t.event_name)) AS first_count
FROM telemetry t GROUP BY t.day"""


def _batch(spark, sf_dir):
    return spark.read.parquet(stored(
        spark, sf_dir, "document-batch", lambda to: _batch_rows(spark, sf_dir).write.parquet(to)))


def _batch_rows(spark, sf_dir):
    """Documents as they arrive: first and second revisions, a repeated first one, and some outside the contract."""
    first = _documents(spark, sf_dir)
    day = F.dayofmonth(F.to_date("bucket_date"))
    texts = export.document_text(first)
    second = export.document_text(first.where(day % 3 == 0).withColumn("revision", F.lit(2).cast("bigint")))
    broken = {
        5: ('"privacy_mode":"aggregate_only"', '"privacy_mode":"raw"'),
        6: ('"source_region"', '"run_id":"x","source_region"'),
        7: ('"count":', '"count":-'),
        8: ('"bucket_date":"', '"bucket_date":"x'),
    }
    wrong = export.document_text(first.where(day.isin(*broken)).withColumn("revision", F.lit(9).cast("bigint")))
    value = F.col("value")
    for number, (old, new) in broken.items():
        on_day = F.dayofmonth(F.to_date(F.get_json_object("value", "$.bucket_date"))) == number
        value = F.when(on_day, F.replace("value", F.lit(old), F.lit(new))).otherwise(value)
    return texts.unionByName(second).unionByName(texts).unionByName(wrong.select(value.alias("value")))


def _decisions(spark, sf_dir):
    known = _documents(spark, sf_dir).where(F.dayofmonth(F.to_date("bucket_date")) % 2 == 0)
    return export.import_decisions(export.validate_documents(_batch(spark, sf_dir)), known)


def _import_dedup(spark, sf_dir):
    return _decisions(spark, sf_dir).groupBy("bucket_date", "revision", "outcome").agg(
        F.sum("documents").alias("documents"))


_DAYS = f"WITH {telemetry_sql(DUCKDB)}, days AS (SELECT DISTINCT day, day(day) AS dom, strftime(day, '%Y-%m-%d') AS d FROM telemetry)"
_IMPORT_SQL = f"""{_DAYS}
SELECT d AS bucket_date, cast(1 as bigint) AS revision, 'DUPLICATE_IGNORED' AS outcome,
  cast(CASE WHEN dom % 2 = 0 THEN 2 ELSE 1 END as bigint) AS documents FROM days
UNION ALL SELECT d, 1, 'IMPORTED', 1 FROM days WHERE dom % 2 = 1
UNION ALL SELECT d, 2, 'IMPORTED', 1 FROM days WHERE dom % 3 = 0
UNION ALL SELECT CASE WHEN dom = 8 THEN 'x' || d ELSE d END, 9, 'REJECTED', 1 FROM days WHERE dom IN (5, 6, 7, 8)"""


def _export_explode(spark, sf_dir):
    return export.exploded(_decisions(spark, sf_dir).where("outcome = 'IMPORTED'"), "run_end_counts").select(
        "bucket_date", "revision", "end_reason", "end_count", "final_level_sum", "current_gold_sum")


def _ends_sql(days: str) -> str:
    return f"""SELECT strftime(day, '%Y-%m-%d') AS bucket_date, end_reason, count(*) AS end_count,
      {S.big('sum(final_level)')} AS final_level_sum, {_total('current_gold')} AS current_gold_sum
      FROM telemetry WHERE event_name = 'run_ended' AND {days} GROUP BY ALL"""


_EXPLODE_SQL = f"""WITH {telemetry_sql(DUCKDB)}
SELECT *, cast(1 as bigint) AS revision FROM ({_ends_sql('day(day) % 2 = 1')})
UNION ALL SELECT *, 2 FROM ({_ends_sql('day(day) % 3 = 0')})"""


def _latest(spark, sf_dir):
    rows = export.exploded(_decisions(spark, sf_dir).where("outcome <> 'REJECTED'"), "event_counts")
    return export.latest_revision(rows.distinct()).select("bucket_date", "revision", "event_name", "event_count")


_LATEST_SQL = f"""WITH {telemetry_sql(DUCKDB)} SELECT strftime(day, '%Y-%m-%d') AS bucket_date,
  cast(CASE WHEN day(day) % 3 = 0 THEN 2 ELSE 1 END as bigint) AS revision, event_name, count(*) AS event_count
  FROM telemetry GROUP BY ALL"""


def _export_validation(spark, sf_dir):
    checked = export.validate_documents(_batch(spark, sf_dir)).where("size(issues) > 0")
    found = checked.select(F.explode("issues").alias("i"))
    return found.groupBy(F.concat_ws("/", "i.path").alias("path"), "i.message").agg(F.count("*").alias("documents"))


_EXPORT_VALIDATION_SQL = f"""{_DAYS}
SELECT CASE dom WHEN 5 THEN 'privacy_mode' WHEN 6 THEN '' WHEN 7 THEN 'metrics/event_counts' ELSE 'bucket_date' END AS path,
  CASE dom WHEN 5 THEN 'privacy_mode is not a contract value' WHEN 6 THEN 'run_id is not part of the contract'
    WHEN 7 THEN 'event_counts has an entry outside the contract' ELSE 'bucket_date is not a contract value' END AS message,
  count(*) AS documents FROM days WHERE dom IN (5, 6, 7, 8) GROUP BY ALL"""


_ENTRIES = {
    "exports": (["data_class", "destination_region", None], None, []),
    "event_counts": (["event_name", None, None], "event_count", []),
    "upgrade_option_counts": (["item_id", "rarity", "slot"], "shown_count", []),
    "upgrade_selected_counts": (["item_id", "rarity", "slot"], "selected_count", []),
    "run_checkpoint_counts": ([None, None, "checkpoint_number"], "checkpoint_count", [
        "player_level_sum", "current_xp_sum", "xp_to_next_level_sum", "hp_percent_sum", "total_kills_sum", "current_gold_sum"]),
    "run_end_counts": (["end_reason", None, None], "end_count", [
        "run_duration_seconds_sum", "final_level_sum", "total_kills_sum", "current_gold_sum"]),
}


def _entries(tables):
    """Rows of the six tables in one layout: three keys, a count and up to six sums."""
    parts = []
    for name, (keys, count, sums) in _ENTRIES.items():
        def column(source, kind, alias):
            return (F.lit(None) if source is None else F.col(source)).cast(kind).alias(alias)

        padded = [*sums, *[None] * (6 - len(sums))]
        parts.append(tables(name).select(
            F.lit(name).alias("entry"), "schema_version", "bucket_date", "revision",
            *[column(k, kind, f"key_{i}") for i, (k, kind) in enumerate(zip(keys, ("string", "string", "bigint")), 1)],
            column(count, "bigint", "n"), *[column(c, "double", f"sum_{i}") for i, c in enumerate(padded, 1)]))
    return reduce(lambda a, b: a.unionByName(b), parts)


_ENTRIES_SQL = f"""entries AS (
  SELECT 'exports' AS entry, day, 'SYNTHETIC_TEST' AS key_1, 'ap-southeast-2' AS key_2, cast(NULL as bigint) AS key_3, cast(NULL as bigint) AS n,
    cast(NULL as double) AS sum_1, cast(NULL as double) AS sum_2, cast(NULL as double) AS sum_3, cast(NULL as double) AS sum_4,
    cast(NULL as double) AS sum_5, cast(NULL as double) AS sum_6 FROM telemetry GROUP BY day
  UNION ALL SELECT 'event_counts', day, event_name, NULL, NULL, count(*), NULL, NULL, NULL, NULL, NULL, NULL FROM telemetry GROUP BY ALL
  UNION ALL SELECT 'upgrade_option_counts', day, item_id, rarity, slot, count(*), NULL, NULL, NULL, NULL, NULL, NULL FROM ({_SLOTS}) GROUP BY ALL
  UNION ALL SELECT 'upgrade_selected_counts', day, selected_item_id, selected_rarity, selected_slot, count(*), NULL, NULL, NULL, NULL, NULL, NULL
    FROM telemetry WHERE event_name = 'upgrade_selected' GROUP BY ALL
  UNION ALL SELECT 'run_checkpoint_counts', day, NULL, NULL, checkpoint_number, count(*), sum(player_level), {_total('current_xp')},
    {_total('xp_to_next_level')}, {_total('hp_percent')}, sum(total_kills), {_total('current_gold')}
    FROM telemetry WHERE event_name = 'run_checkpoint' GROUP BY ALL
  UNION ALL SELECT 'run_end_counts', day, end_reason, NULL, NULL, count(*), {_total('run_elapsed_seconds')}, sum(final_level), sum(total_kills),
    {_total('current_gold')}, NULL, NULL FROM telemetry WHERE event_name = 'run_ended' GROUP BY ALL)"""


def _entries_sql(revisions: str) -> str:
    return f"""WITH {telemetry_sql(DUCKDB)}, {_ENTRIES_SQL}
SELECT entry, 'aggregate-export-v1' AS schema_version, strftime(day, '%Y-%m-%d') AS bucket_date, revision, key_1, key_2,
  cast(key_3 as bigint) AS key_3, cast(n as bigint) AS n, cast(sum_1 as double) AS sum_1, cast(sum_2 as double) AS sum_2,
  cast(sum_3 as double) AS sum_3, cast(sum_4 as double) AS sum_4, cast(sum_5 as double) AS sum_5, cast(sum_6 as double) AS sum_6
FROM entries JOIN (SELECT day, unnest({revisions}) AS revision FROM (SELECT DISTINCT day FROM telemetry)) USING (day)"""


def _import_stored(spark, sf_dir):
    """Documents imported twice, and their six tables as they are stored then."""
    base = new_folder(spark, "lake")
    for _ in range(2):
        imports.import_documents(spark, _batch(spark, sf_dir), base)
    return _entries(lambda name: imports.read_import(spark, base, name))


def _import_latest(spark, sf_dir):
    """Two imports, first revisions before second ones; the rows of each day's highest revision."""
    base = new_folder(spark, "lake")
    first = F.get_json_object("value", "$.revision") == "1"
    for part in (first, ~first):
        imports.import_documents(spark, _batch(spark, sf_dir).where(part), base)
    return _entries(lambda name: imports.latest_rows(spark, base, name))


def _export_entries(spark, sf_dir):
    """Export documents stored one by one and read back: every entry of every day."""
    folder = new_folder(spark, "documents")
    imports.save_documents(export.export_documents(silver(spark, sf_dir), revision=3), folder)
    documents = imports.read_documents(spark, folder).select(F.from_json("value", EXPORT).alias("d")).select("d.*")
    return _entries(lambda name: documents if name == "exports" else export.exploded(documents, name))


# --- storage -------------------------------------------------------------------------------------


def _retention(spark, sf_dir):
    return comparable(lake.expired_dates(silver(spark, sf_dir), date(2024, 2, 10)))


def _window(spark, sf_dir):
    rows = lake.rolling_window(silver(spark, sf_dir), date(2024, 1, 20), 10)
    return comparable(rows.groupBy("received_date").agg(F.count("*").alias("events")))


def _external_window(spark, sf_dir):
    """Silver in date folders as an external table, joined with the stored days of a control table."""
    base = new_folder(spark, "lake")
    silver(spark, sf_dir).withColumn("quality_issue_count", F.lit(0).cast("bigint")).write.partitionBy("received_date").parquet(f"{base}/silver")
    days = stage(silver(spark, sf_dir).select(F.col("received_date").alias("day")).distinct(), "days")
    wanted = days.where("day BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND dayofmonth(day) % 2 = 0")
    table = lake.external_table(spark, base)
    rows = table.join(wanted, table["received_date"] == wanted["day"])
    return comparable(rows.groupBy("received_date").agg(F.count("*").alias("events"), F.count_distinct("run_id").alias("runs")))


def _bronze_sized(spark, sf_dir):
    """Bronze lines that came in very many small pieces, written in files of a bounded size; per day lines, bytes and a digest of the lines."""
    folder = new_folder(spark, "bronze")
    pieces = bronze_lines(spark, sf_dir).repartition(64)
    lake.sized(pieces, "received_date").write.partitionBy("received_date").option("compression", "gzip").text(folder)
    lines = bronze.scan_bronze(spark, folder).select("value", "received_date", F.input_file_name().alias("file"))
    files = lines.groupBy("received_date", "file").agg(F.count("*").alias("lines"), F.count_distinct(_delivered_id()).alias("ids"))
    # The test tables give a day a few hundred KB, under the advisory size: one file.
    return comparable(files.groupBy("received_date").agg(F.sum("lines").alias("lines"), F.sum("ids").alias("event_ids"), F.count("*").alias("files")))


def _delivered_id():
    return F.get_json_object("value", "$.event.event_id")


def _evolution(spark, sf_dir):
    from workload.gold_queries import kept

    runs = kept(spark, sf_dir, "run_summary")
    columns = [name for name in GOLD["run_summary"] if name != "death_cause"]
    older = runs.where("game_version = '1.0.0'").select(*columns)
    newer = runs.where("game_version <> '1.0.0'")
    return lake.evolved(older, newer).select("run_id", "game_version", "end_reason", "death_cause")


def _rekey(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    generated = rekey.rekeyed(rows.select(F.parse_json(event_json()).alias("event")), copies=2)
    member = lambda name: F.try_variant_get("event", f"$.{name}", "string").alias(name)
    return generated.select(
        F.col("copy").cast("bigint").alias("copy"), *[member(n) for n in (
            "run_id", "event_id", "choice_id", "source_type", "event_name", "game_version", "end_reason")],
        F.try_variant_get("event", "$.event_sequence", "bigint").alias("event_sequence"))


def _uuid_sql(kind: str, *parts: str) -> str:
    digest = f"md5(concat_ws('|', '{kind}', 'scenario', copy, {', '.join(parts)}))"
    return (f"substring({digest}, 1, 8) || '-' || substring({digest}, 9, 4) || '-4' || substring({digest}, 14, 3) "
            f"|| '-8' || substring({digest}, 18, 3) || '-' || substring({digest}, 21, 12)")


_REKEY_SQL = f"""WITH {telemetry_sql(DUCKDB)} SELECT cast(copy as bigint) AS copy, {_uuid_sql('run', 'run_id')} AS run_id,
  {_uuid_sql('event', 'run_id', 'event_id')} AS event_id,
  CASE WHEN choice_id IS NOT NULL THEN {_uuid_sql('choice', 'run_id', 'choice_id')} END AS choice_id,
  'CONTROLLED_SCENARIO' AS source_type, event_name, game_version, end_reason, event_sequence
FROM telemetry, (VALUES ('1'), ('2')) c(copy)"""


QUERIES = {
    "telemetry_coverage": Query(
        lambda spark, sf_dir: comparable(telemetry(spark, sf_dir, faults=True).groupBy("day").agg(
            F.count("*").alias("events"), F.count_distinct("event_id").alias("event_ids"))),
        "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS events, count(DISTINCT event_id) AS event_ids FROM events GROUP BY 1"),
    "bronze_scan": Query(_bronze_scan, D.select(f"""run_id, count(*) AS deliveries,
        {D.moment('min(received_us)')} AS first_received_at, {D.moment('max(received_us)')} AS last_received_at,
        count(DISTINCT event_id) AS event_ids FROM deliveries GROUP BY run_id""")),
    "bronze_envelope": Query(_bronze_envelope, f"""WITH {telemetry_sql(DUCKDB)} SELECT 1 AS bronze_record_version, event_id,
        strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S.%gZ') AS received_at, ingestion_channel FROM telemetry"""),
    "envelope_check": Query(_envelope_check, _envelope_sql()),
    "channel_policy": Query(_channel_policy, f"""WITH {telemetry_sql(DUCKDB)}, routed AS (
        SELECT event_id, {_CHANNEL_SQL} AS channel, source_type FROM telemetry)
        SELECT event_id, channel, source_type, ({_ALLOWED_SQL}) AS allowed FROM routed"""),
    "body_checks": Query(_body_checks, _faulty(f" SELECT n, {_BODY_SQL} AS body_error FROM telemetry")),
    "ingest_split": Query(_ingest_split, _INGEST_SQL),
    "event_validation": _validated("true", "true"),
    "privacy_key_scan": _validated("code = 'prohibited_field'", "code = 'prohibited_field'"),
    "schema_rules": _validated("code = 'schema_invalid'", "code = 'schema_invalid'"),
    "options_rules": _validated("get(path, 0) = 'options'", "path = 'options'"),
    "dedup_earliest": Query(_dedup_earliest, D.select(f"""run_id, event_id, event_sequence,
        {D.moment('received_us')} AS first_received_at, ingestion_channel, cast(retries as bigint) AS retries,
        cast(conflicts as bigint) AS conflicts FROM uniq""")),
    "dedup_counts": Query(_dedup_counts, D.select(
        "run_id, source_type, input_event_count, unique_event_count, exact_retry_count, conflicting_duplicate_count "
        "FROM runs")),
    "cross_run_conflicts": Query(
        lambda spark, sf_dir: _issue_view(R.cross_run_issues(
            _unique(spark, sf_dir), R.shared_event_ids(_unique(spark, sf_dir)))),
        D.select("* FROM cross_run_conflict")),
    "event_id_index": Query(_event_id_index, D.select("* FROM cross_run_conflict")),
    "late_events": Query(
        lambda spark, sf_dir: _issue_view(R.late_issues(_unique(spark, sf_dir))), D.select("* FROM late_event")),
    "received_date_owner": Query(
        lambda spark, sf_dir: R.runs_owned_by(_deliveries(spark, sf_dir), _BACKFILL_DAY),
        D.select(f"run_id FROM runs WHERE {D.day('opened_us')} = '{_BACKFILL_DAY}'")),
    "stream_dedup": Query(_stream_dedup, D.select(f"""run_id, route, cast(sum(c) as bigint) AS deliveries FROM (
        SELECT run_id, 'late' AS route, count(*) AS c FROM deliveries WHERE {_LATE_SQL} GROUP BY 1
        UNION ALL SELECT run_id, unnest(['kept', 'repeat']), unnest([1, c - 1]) FROM (
          SELECT run_id, event_id, body, count(*) AS c FROM deliveries WHERE NOT ({_LATE_SQL}) GROUP BY ALL))
        GROUP BY 1, 2 HAVING sum(c) > 0""")),
    "stream_run_close": Query(_stream_run_close, D.select(f"""run_id, run_status, source_type, {D.day('opened_us')} AS received_date,
        unique_event_count, quality_issue_count FROM runs
        WHERE opened_us // 1000 + 86400000 < (SELECT max(received_us) FROM deliveries) // 1000 - 7200000""")),
    "seq_conflict": _rule("seq_conflict", lambda spark, sf_dir: sequence.sequence_conflicts(
        _members(spark, sf_dir), _ordered(spark, sf_dir))),
    "seq_gap": _order_rule("seq_gap"),
    "run_boundary": _order_rule("run_boundary"),
    "correlation": _order_rule("correlation"),
    "before_start": _order_rule("before_start"),
    "after_end": _order_rule("after_end"),
    "choice_order": _order_rule("choice_order"),
    "checkpoint_rules": _order_rule("checkpoint_rules"),
    "counter_decreased": _order_rule("counter_decreased"),
    "choice_reuse": _rule("choice_reuse", lambda spark, sf_dir: sequence.choice_issues(_ordered(spark, sf_dir))),
    "choice_linkage": _rule("choice_linkage", lambda spark, sf_dir: sequence.choice_issues(_ordered(spark, sf_dir))),
    "run_status": Query(_run_status, D.select(f"{_RUN_COLUMNS} FROM runs")),
    "silver_rows": Query(_silver_rows, _SILVER_SQL),
    "silver_quarantine_split": Query(_split, D.select("""CASE WHEN q.run_status = 'invalid' THEN 'quarantine' ELSE 'silver'
        END AS target, q.run_status, count(*) AS events, count(DISTINCT run_id) AS runs
        FROM uniq u JOIN runs q USING (run_id) GROUP BY ALL""")),
    "date_backfill": Query(_date_backfill, D.select(f"""u.run_id, u.event_id, q.run_status, q.quality_issue_count,
        '{_BACKFILL_DAY}' AS received_date,
        CASE WHEN q.run_status = 'invalid' THEN 'quarantine' ELSE 'silver' END AS target
        FROM uniq u JOIN runs q USING (run_id) WHERE {D.day('q.opened_us')} = '{_BACKFILL_DAY}'""")),
    "silver_sink": Query(_silver_sink, f"""WITH {telemetry_sql(DUCKDB)} SELECT strftime(day, '%Y-%m-%d') AS received_date,
        event_name, count(*) AS events, count(DISTINCT run_id) AS runs FROM telemetry GROUP BY ALL"""),
    "rolling_window_scan": Query(_window, f"""WITH {telemetry_sql(DUCKDB)} SELECT strftime(day, '%Y-%m-%d') AS received_date,
        count(*) AS events FROM telemetry WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY ALL"""),
    "external_window": Query(_external_window, f"""WITH {telemetry_sql(DUCKDB)} SELECT strftime(day, '%Y-%m-%d') AS received_date,
        count(*) AS events, count(DISTINCT run_id) AS runs FROM telemetry
        WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND day(day) % 2 = 0 GROUP BY ALL"""),
    "bronze_sized": Query(_bronze_sized, D.select(f"""{D.day('received_us')} AS received_date, count(*) AS lines,
        count(DISTINCT event_id) AS event_ids, cast(1 as bigint) AS files FROM deliveries GROUP BY 1""")),
    "retention_filter": Query(_retention, f"""WITH {telemetry_sql(DUCKDB)} SELECT strftime(day, '%Y-%m-%d') AS received_date,
        count(*) AS row_count FROM telemetry WHERE day < DATE '2024-01-11' GROUP BY ALL"""),
    "schema_evolution": Query(_evolution, S.select("""run_id, game_version, end_reason,
        CASE WHEN game_version <> '1.0.0' THEN death_cause END AS death_cause FROM product""")),
    "daily_event_counts": _daily(export.daily_event_counts, _EVENT_COUNTS),
    "daily_option_counts": Query(
        lambda spark, sf_dir: comparable(export.daily_option_counts(silver(spark, sf_dir))),
        f"""WITH {telemetry_sql(DUCKDB)}, slots AS ({_SLOTS}) SELECT strftime(day, '%Y-%m-%d') AS bucket_date, item_id,
        rarity, cast(slot as bigint) AS slot, count(*) AS shown_count FROM slots GROUP BY ALL"""),
    "daily_selected_counts": _daily(export.daily_selected_counts, """selected_item_id AS item_id, selected_rarity AS rarity,
        cast(selected_slot as bigint) AS slot, count(*) AS selected_count FROM telemetry
        WHERE event_name = 'upgrade_selected' GROUP BY ALL"""),
    "daily_checkpoint_sums": _daily(export.daily_checkpoint_sums, f"""checkpoint_number, count(*) AS checkpoint_count,
        {S.big('sum(player_level)')} AS player_level_sum, {_total('current_xp')} AS current_xp_sum,
        {_total('xp_to_next_level')} AS xp_to_next_level_sum, {_total('hp_percent')} AS hp_percent_sum,
        {S.big('sum(total_kills)')} AS total_kills_sum, {_total('current_gold')} AS current_gold_sum
        FROM telemetry WHERE event_name = 'run_checkpoint' GROUP BY ALL"""),
    "daily_run_end_sums": _daily(export.daily_run_end_sums, _ENDS),
    "export_document": Query(_export_document, _DOCUMENT_SQL),
    "export_import_dedup": Query(_import_dedup, _IMPORT_SQL),
    "export_explode": Query(_export_explode, _EXPLODE_SQL),
    "export_latest_revision": Query(_latest, _LATEST_SQL),
    "export_validation": Query(_export_validation, _EXPORT_VALIDATION_SQL),
    "export_entries": Query(_export_entries, _entries_sql("[3]")),
    "export_import_stored": Query(_import_stored, _entries_sql("CASE WHEN day(day) % 3 = 0 THEN [1, 2] ELSE [1] END")),
    "export_import_latest": Query(_import_latest, _entries_sql("CASE WHEN day(day) % 3 = 0 THEN [2] ELSE [1] END")),
    "rekey_runs": Query(_rekey, _REKEY_SQL),
    "bronze_rejects": Query(_bronze_rejects, _REJECTS_SQL),
    "rebuild_incremental": Query(_rebuild_incremental, D.select(f"""u.run_id, u.event_id, q.run_status, q.quality_issue_count,
        {D.day('q.opened_us')} AS received_date, CASE WHEN q.run_status = 'invalid' THEN 'quarantine' ELSE 'silver' END AS target
        FROM uniq u JOIN runs q USING (run_id)""")),
    "gold_from_bronze": Query(_gold_from_bronze, _GOLD_FROM_BRONZE_SQL),
}
