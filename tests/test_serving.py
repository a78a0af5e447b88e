"""Reconciliation, governed metrics, dashboards, report dataset, export import, and generated runs."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from conftest import event_frame
from pyspark.sql import functions as F

from runtrace.operators import export, rekey, report, semantic, serve
from runtrace.operators.reconcile import ReconcileInputError, reconcile
from runtrace.schemas import EXPORT, GOLD


def test_same_numbers_in_other_clothes(spark):
    left = spark.createDataFrame([("valid", Decimal("2"), None)], "RUN_STATUS string, RUN_COUNT decimal(38,0), EXTRA int")
    right = spark.createDataFrame([("valid", "2.005", None)], "run_status string, run_count string, extra int")
    assert reconcile(left, right, ["run_status"], ["run_count", "extra"]).count() == 0


def test_differences_and_missing_rows(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("d", None)], "k string, v int")
    right = spark.createDataFrame([("a", 2), ("c", 2), (None, 3), ("d", 4)], "k string, v int")
    found = sorted((str(r["key"][0]), r["column"], r["reason"]) for r in reconcile(left, right, ["k"], ["v"]).collect())
    assert found == [("a", "v", "value_mismatch"), ("b", "*", "missing_in_right"), ("c", "*", "missing_in_left"),
                     ("d", "v", "value_mismatch")]


def test_unusable_input(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1)], "k string, v int")
    with pytest.raises(ReconcileInputError, match="more than once"):
        reconcile(rows, rows.limit(0), ["k"], ["v"])
    with pytest.raises(ReconcileInputError, match="missing"):
        reconcile(rows, rows, ["k"], ["w"])
    with pytest.raises(ReconcileInputError):
        reconcile(rows, rows, [], ["v"])
    with pytest.raises(ReconcileInputError):
        reconcile(rows, rows, ["k"], ["v"], Decimal("-1"))


def test_only_governed_names(spark):
    runs = spark.createDataFrame([("r", "1.0")], "run_id string, game_version string")
    view = semantic.runs_view()
    for dimensions, metrics in ((["run_id"], ["run_count"]), (["game_version"], ["total_kills"]), ([], [])):
        with pytest.raises(ValueError):
            view.query(runs, dimensions, metrics)
    assert view.query(runs, ["game_version"], ["run_count"]).columns == ["game_version", "run_count"]


def test_version_filter_and_labels(spark):
    rows = spark.createDataFrame([("1.0", "valid", 1), ("1.1", "odd", 2)], "game_version string, run_status string, n int")
    assert serve.of_version(rows, "1.1").count() == 1 and serve.of_version(rows, None).count() == 2
    for wrong in ("1' OR '1'='1", "", "x" * 33):
        with pytest.raises(ValueError):
            serve.of_version(rows, wrong)
    shown = serve.relabelled(rows)
    assert shown.columns == ["게임 버전", "Run 상태", "n"]
    assert sorted(r["Run 상태"] for r in shown.collect()) == ["odd", "정상"]


def test_endings_are_normalised(spark):
    runs = spark.createDataFrame(
        [("player_death", None, 10.0), ("player_death", "fall", 20.0), ("player_quit", None, 5.0), (None, None, None)],
        "end_reason string, death_cause string, run_duration_seconds double")
    runs = runs.withColumn("game_version", F.lit("1"))
    found = {(r["end_reason"], r["death_cause"]) for r in serve.run_endings(runs).collect()}
    assert found == {("player_death", "not_collected_legacy"), ("player_death", "fall"),
                     ("player_quit", "not_applicable"), ("incomplete", "not_applicable")}
    assert serve.death_causes(runs).count() == 2


def sections(spark, **changed):
    empty = {
        name: spark.createDataFrame([], ", ".join(f"{c} {GOLD[table][c]}" for c in columns))
        for name, (table, columns, _) in report.SECTIONS.items()
    }
    empty["run_outcomes"] = spark.createDataFrame(
        [("victory", 7, Decimal("12.50"), Decimal("431.07"))], empty["run_outcomes"].schema)
    return {**empty, **changed}


def test_report_document(spark):
    row = report.checked_report("2025-11-23", sections(spark)).first()
    document = json.loads(row["document"])
    assert document["schema_version"] == "gold-report-input-v1" and row["document_bytes"] == len(row["document"])
    assert document["metrics"]["run_outcomes"] == [{
        "average_run_seconds": 431.07, "end_reason": "victory", "ended_run_count": 7, "ended_run_percentage": 12.5}]
    assert set(document["metrics"]) == set(report.SECTIONS)


def test_report_refuses(spark):
    good = sections(spark)["run_outcomes"]
    seven = spark.createDataFrame(good.collect() * 7, good.schema)
    with pytest.raises(report.ReportInputError, match="more than 6 rows"):
        report.checked_report("2025-11-23", sections(spark, run_outcomes=seven))
    with pytest.raises(report.ReportInputError, match="surplus"):
        report.checked_report("2025-11-23", sections(spark, run_outcomes=good.withColumn("surplus", F.lit(1))))
    unknown = good.withColumn("average_run_seconds", F.lit(None).cast("decimal(38,2)"))
    with pytest.raises(report.ReportInputError, match="average_run_seconds"):
        report.checked_report("2025-11-23", sections(spark, run_outcomes=unknown))
    with pytest.raises(ValueError):
        report.checked_report("2025/11/23", sections(spark))


def document(**changed):
    return {
        "schema_version": "aggregate-export-v1", "bucket_date": "2026-03-01", "revision": 1, "source_region": "TR",
        "destination_region": "ap-southeast-2", "privacy_mode": "aggregate_only", "data_class": "SYNTHETIC_TEST",
        "metrics": {
            "event_counts": [{"event_name": "run_started", "count": 3}],
            "upgrade_option_counts": [{"item_id": "bone", "rarity": "common", "slot": 1, "shown_count": 2}],
            "upgrade_selected_counts": [],
            "run_checkpoint_counts": [],
            "run_end_counts": [{"end_reason": "player_death", "end_count": 1, "run_duration_seconds_sum": 9.5,
                                "final_level_sum": 4, "total_kills_sum": 7, "current_gold_sum": 2}],
        },
        **changed,
    }


def test_export_contract(spark):
    names = ["comment", "owner", "bucket_hour", "sourceRegion", "metrics2", "revisions", "", "Schema_Version"]
    base = document()["metrics"]
    end = base["run_end_counts"][0]

    def metrics(**changed):
        return document(metrics={**base, **changed})

    good = [document(), document(data_class="PRIVACY_RELEASED_PROD_AGGREGATE"), metrics(event_counts=[])]
    bad = [
        *[document(**{name: "x"}) for name in names],
        metrics(event_counts=[{"event_name": "session_started", "count": 1}]),
        metrics(run_end_counts=[{**end, "unexpected": 1}]),
        metrics(run_end_counts=[{**end, "end_reason": "rage_quit"}]),
        metrics(run_end_counts=[end, {k: v for k, v in end.items() if k != "end_count"}]),
        metrics(event_counts=[{"event_name": "run_started", "count": -1}]),
        metrics(event_counts=[{"event_name": "run_started", "count": 1.5}]),
        metrics(event_counts=[{"event_name": "run_started", "count": "1"}]),
        metrics(more=[]), metrics(event_counts=None), document(metrics=[]), document(revision=0),
        document(bucket_date="2026-02-30"), document(source_region="EU"),
        {k: v for k, v in document().items() if k != "privacy_mode"},
    ]
    texts = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(good + bad)] + [(99, "[1]")], "i int, value string")
    checked = {r["i"]: r["issues"] for r in export.validate_documents(texts).collect()}
    assert [i for i in range(len(good)) if checked[i]] == []
    assert [i for i in checked if i >= len(good) and not checked[i]] == []


def test_import_is_idempotent(spark):
    texts = [document(), document(), document(revision=2), document(revision=0)]
    rows = spark.createDataFrame([(json.dumps(d),) for d in texts], "value string")
    nothing = spark.createDataFrame([], EXPORT)
    first = export.import_decisions(export.validate_documents(rows), nothing)
    outcomes = sorted((r["revision"], r["outcome"], r["documents"]) for r in first.collect())
    assert outcomes == [(0, "REJECTED", 1), (1, "DUPLICATE_IGNORED", 1), (1, "IMPORTED", 1), (2, "IMPORTED", 1)]
    again = export.import_decisions(export.validate_documents(rows), first.where("outcome = 'IMPORTED'"))
    assert again.where("outcome = 'IMPORTED'").count() == 0
    taken = first.where("outcome = 'IMPORTED'")
    assert export.exploded(taken, "event_counts").count() == 2
    latest = export.latest_revision(export.exploded(taken, "run_end_counts"))
    assert [(r["revision"], r["total_kills_sum"]) for r in latest.collect()] == [(2, 7)]


def test_generated_runs_are_valid_and_linked(spark, full_run):
    events = event_frame(spark, full_run + [full_run[3]]).select("event")
    generated = rekey.controlled_scenarios(events, copies=2).collect()
    parsed = [json.loads(str(r["event"].toJson())) for r in generated]
    assert len(parsed) == 12 and {e["source_type"] for e in parsed} == {"CONTROLLED_SCENARIO"}
    assert len({e["run_id"] for e in parsed}) == 2 and len({e["event_id"] for e in parsed}) == 10
    assert len({e["choice_id"] for e in parsed if "choice_id" in e}) == 2
    assert not {e["event_id"] for e in parsed} & {e["event_id"] for e in full_run}
    with pytest.raises(rekey.ScenarioError):
        rekey.controlled_scenarios(event_frame(spark, full_run[:3]).select("event"))
