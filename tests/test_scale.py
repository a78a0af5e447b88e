"""Steps that read wide rows: how much they carry, and that they say what the plain forms say."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from runtrace.functions.payload import each, typed
from runtrace.operators import gold_runs, rekey, sequence
from workload import gold_queries, projection


def _plan(rows) -> str:
    return rows._jdf.queryExecution().optimizedPlan().toString()


def _events(spark, rows):
    """(run_id, event_id, second of receipt, sequence number, other members) as deduplicated events."""
    texts = [(r, e, t, n, json.dumps({"event_sequence": n, "event_name": "run_started", **more})) for r, e, t, n, more in rows]
    return spark.createDataFrame(texts, "run_id string, event_id string, t bigint, event_sequence bigint, event_json string").select(
        "run_id", "event_id", "event_sequence", "event_json", F.timestamp_seconds("t").alias("first_received_at"))


def test_only_contested_numbers_are_grouped(spark):
    events = _events(spark, [
        ("a", "1", 5, 1, {}), ("a", "2", 9, 2, {}), ("a", "3", 7, 2, {"choice_id": "x"}), ("a", "4", 7, 2, {"choice_id": "b"}),
        ("b", "5", 1, 2, {}), ("b", "6", 1, None, {}), (None, "7", 3, 1, {}), (None, "8", 2, 1, {}),
    ])
    ordered = sequence.ordered_events(events)
    found = {(r["run_id"], r["event_sequence"]): (r["event_id"], r["claims"]) for r in ordered.collect()}
    assert found == {("a", 1): ("1", 1), ("a", 2): ("4", 3), ("b", 2): ("5", 1), (None, 1): ("8", 2)}
    # Below the grouping stands the join with the contested numbers: texts of other events are neither shuffled nor sorted.
    assert "LeftAnti" in _plan(ordered) and "LeftSemi" in _plan(ordered)


def test_members_in_one_pass_are_those_of_single_paths(spark):
    texts = ['{"event_sequence":3.0,"choice_id":7,"options":[{"slot":"1","item_id":4,"x":2},null,3],"run_elapsed_seconds":"12.5"}',
             '{"event_sequence":"9","options":{"slot":1},"selected_slot":99999999999999999999,"choice_sequence":2.7,"event_name":null}',
             '[1]', 'null', '5', 'bad', '{"options":[{"slot":1.5,"item_id":null}],"event_sequence":true,"source_type":1.50}']
    rows = spark.createDataFrame([("r", str(i), text) for i, text in enumerate(texts)], "run_id string, event_id string, event_json string")
    rows = rows.withColumn("first_received_at", F.timestamp_seconds(F.lit(0)))
    at_once = sequence.typed_events(rows)
    singly = rows.select("event_id", *typed(F.try_parse_json("event_json"), **sequence._MEMBERS)).orderBy("event_id")
    assert at_once.select(*singly.columns).orderBy("event_id").collect() == singly.collect()
    assert _plan(at_once).count("variant_get") == 1


def test_lists_are_columns_before_they_are_spread(spark):
    rows = spark.range(3)
    found = F.array_compact(F.array(*[F.when(F.col("id") > k, F.struct(F.lit(k).alias("k"))) for k in (0, 1)]))
    spread = each(rows, ["id"], found, "i")
    assert sorted((r["id"], r["i"]["k"]) for r in spread.collect()) == [(1, 0), (2, 0), (2, 1)]
    generate = next(line for line in _plan(spread).splitlines() if "Generate" in line)
    assert "filter(" not in generate and "array(" not in generate


def test_rows_without_issues_are_left_out_first(spark):
    rows = spark.createDataFrame([("a", "1", 1, 5), ("a", "2", 2, None)], "run_id string, event_id string, event_sequence bigint, v int")
    found = sequence._found(rows, [(F.col("v") > 3, sequence._row("r", "C", "m", [], 1)), (F.col("v") > 4, sequence._row("s", "C", "m", [], 1))])
    assert sorted((r["rule"], r["event_id"]) for r in found.collect()) == [("r", "1"), ("s", "1")]


def test_copies_share_what_is_written_once(spark):
    events = spark.createDataFrame([('{"run_id":"r","event_id":"e","choice_id":"c","n":1E2,"x":null}',)], "j string").select(F.parse_json("j").alias("event"))
    made = rekey.rekeyed(events, 2)
    assert "Explode" in _plan(made).title()
    below = _plan(made).title().split("Explode", 1)[1]
    assert "Map" in below  # the other members are written below the copies
    texts = [json.loads(r[0]) for r in made.select(F.to_json("event")).collect()]
    assert len({t["run_id"] for t in texts}) == 2 and all(t["n"] == 100 and t["x"] is None and t["source_type"] == "CONTROLLED_SCENARIO" for t in texts)


def test_settings_of_the_telemetry_queries(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), F.lit(2.0).alias("value"),
                           F.lit('{"k": 3}').alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    try:
        projection.telemetry(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
    finally:
        for name in ("spark.sql.codegen.hugeMethodLimit", "spark.sql.files.maxPartitionBytes"):
            spark.conf.unset(name)


def test_members_of_a_run_are_read_in_one_pass(spark):
    silver = spark.createDataFrame(
        [("a", "run_started", '{"map_id":"m","starting_max_hp":"12.5"}'),
         ("a", "run_ended", '{"end_reason":"x","total_kills":3.0,"final_level":"y","final_upgrades":[{"item_id":"i"},null],"map_id":"no"}'),
         ("a", "run_checkpoint", '{"checkpoint_number":4}'), ("b", "run_ended", '{"final_upgrades":{"no":1}}'), ("c", "run_ended", '[1]')],
        "run_id string, event_name string, event_payload_json string")
    silver = silver.select("*", *[F.lit("s").alias(n) for n in ("source_type", "game_version", "run_status")], *[F.lit(1).cast("bigint").alias(n) for n in (
        "run_elapsed_seconds", "event_sequence", "input_event_count", "unique_event_count", "exact_retry_count", "conflicting_duplicate_count",
        "quality_issue_count")], F.lit(None).cast("date").alias("received_date"), F.timestamp_seconds(F.lit(0)).alias("first_received_at"))
    runs = gold_runs.run_summary(silver)
    found = {r["run_id"]: (r["map_id"], r["starting_max_hp"], r["end_reason"], r["total_kills"], r["final_level"], r["final_upgrade_count"],
                           r["final_upgrades_json"], r["highest_checkpoint_number"]) for r in runs.collect()}
    assert found == {"a": ("m", 12.5, "x", 3, None, 2, '[{"item_id":"i"},null]', 4),
                     "b": (None, None, None, None, None, None, '{"no":1}', None), "c": (None,) * 8}
    assert _plan(runs).count("parseJson") == 1 and _plan(runs).count("$.") == 0


def test_runs_are_summed_up_once_for_all_gold_tables(spark, monkeypatch, tmp_path):
    spark.range(500).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1_704_067_200).cast("timestamp_ntz").alias("ts"),
                            F.lit(2.0).alias("value"), F.lit('{"k": 3}').alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    made = []
    whole = gold_runs.product_run_summary
    monkeypatch.setattr(gold_runs, "product_run_summary", lambda silver: made.append(1) or whole(silver))
    for name in ("weapon_performance", "option_outcome_comparison", "upgrade_post_selection", "run_progression"):
        gold_queries.gold(spark, str(tmp_path), name).collect()
    assert len(made) == 1
