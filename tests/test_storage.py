"""Dates on disk, the whole job, and the streams."""

from __future__ import annotations

import json
import os
import threading
from datetime import date
from decimal import Decimal

import pyarrow.parquet as pq
from conftest import bronze_lines, rename
from pyspark.sql import functions as F

from runtrace.functions.numeric import LARGEST, mean, total
from runtrace.operators.export import daily_run_end_sums
from runtrace.plans.run_date import rebuild_dates, rebuild_silver, run_date
from runtrace.schemas import GOLD, SILVER
from runtrace.sources import lake, staging
from runtrace.sources.bronze import open_envelopes
from runtrace.sources.catalog import default_catalog
from runtrace.sources.kept import keep_deliveries
from runtrace.sources.staging import shared_folder
from runtrace.streaming import ingest


def store(lines, path):
    lines.write.mode("append").option("compression", "gzip").text(path)


def test_rerun_replaces_a_date_even_with_nothing(spark, full_run, tmp_path):
    bronze, base = str(tmp_path / "bronze"), str(tmp_path / "lake")
    store(bronze_lines(spark, full_run[:4]), bronze)
    first = rebuild_silver(spark, bronze, base, "2026-03-01")
    assert (first.silver_run_count, first.quarantine_run_count) == (1, 0)
    assert [r["run_status"] for r in lake.read_table(spark, base).select("run_status").distinct().collect()] == ["incomplete"]
    store(bronze_lines(spark, full_run[4:], times=["2026-03-01T10:09:00Z"]), bronze)  # the end arrives
    again = [rebuild_silver(spark, bronze, base, "2026-03-01") for _ in range(2)]
    assert again[0] == again[1]
    rows = lake.read_table(spark, base)
    assert rows.count() == 5 and {r["run_status"] for r in rows.collect()} == {"valid"}
    assert set(SILVER.fieldNames()) <= set(rows.columns)
    store(bronze_lines(spark, [{**full_run[3], "total_kills": 1}], times=["2026-03-01T10:20:00Z"]), bronze)
    moved = rebuild_silver(spark, bronze, base, "2026-03-01")
    assert (moved.silver_run_count, moved.quarantine_run_count) == (0, 1)
    assert lake.read_table(spark, base).count() == 0
    assert lake.read_table(spark, base, "quarantine").count() == 5
    assert lake.read_table(spark, base, "run_issues").count() == 1


def test_whole_job(spark, full_run, tmp_path):
    bronze, base = str(tmp_path / "bronze"), str(tmp_path / "lake")
    runs = [rename(full_run, f"{i:03d}", f"3{i:03d}0000") for i in range(3)]
    events = [e for run in runs for e in run] + rename(full_run[:4], "900", "39000000")
    store(bronze_lines(spark, events, times=["2026-03-01T10:00:00Z"] * len(events)), bronze)
    result = run_date(spark, bronze, base, "2026-03-01", default_catalog(spark), with_report=True)
    assert result.write.silver_run_count == 4
    assert set(result.gold) == set(GOLD)
    assert result.gold["run_summary"].count() == 4
    assert {k: v for k, v in result.gold["run_summary"].dtypes} == GOLD["run_summary"]
    weapon = {r["weapon_id"]: r for r in result.gold["weapon_popularity"].collect()}
    assert weapon["bone"]["first_selected_run_count"] == 4
    document = json.loads(spark.read.text(result.report_path).first()["value"])
    assert document["metrics"]["run_outcomes"][0]["ended_run_count"] == 3


def test_retention_and_window(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(60).select(F.col("id"), F.expr("date_add(DATE '2026-01-01', cast(id as int))").alias("received_date"))
    rows.write.partitionBy("received_date").parquet(f"{base}/silver")
    stored = lake.read_table(spark, base)
    assert lake.rolling_window(stored, date(2026, 2, 10), 30).count() == 31
    dropped = lake.drop_expired(spark, base, ("silver", "absent"), date(2026, 2, 10))
    assert len(dropped) == 10 and dropped[0] == "silver/received_date=2026-01-01"
    assert lake.read_table(spark, base).count() == 50


def test_catalog_table_dates_are_replaced(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS dates_check")
    rows = spark.createDataFrame([(1, date(2026, 1, 1)), (2, date(2026, 1, 2))], "n int, received_date date")
    rows.write.partitionBy("received_date").option("path", str(tmp_path / "t")).saveAsTable("dates_check")
    lake.replace_table_date(rows.withColumn("n", F.col("n") + 10), "dates_check", "2026-01-02")
    assert sorted(r["n"] for r in spark.table("dates_check").collect()) == [1, 12]
    lake.replace_table_date(rows.limit(0), "dates_check", "2026-01-01")
    assert [r["n"] for r in spark.table("dates_check").collect()] == [12]
    spark.sql("DROP TABLE dates_check")


def test_ingest_stream_splits_and_repeats_safely(spark, full_run, tmp_path):
    source, bronze, rejects = (str(tmp_path / n) for n in ("in", "bronze", "rejects"))
    bodies = [json.dumps(e) for e in full_run] + ["{broken", json.dumps({**full_run[2], "deviceId": "secret-device"})]
    rows = [(b, False, "turkiye_gateway") for b in bodies] + [(json.dumps(full_run[2]), False, "load_test_runner")]
    spark.createDataFrame(rows, ingest.REQUESTS).write.json(source)
    stream = spark.readStream.schema(ingest.REQUESTS).json(source)
    ingest.start_ingest(stream, bronze, rejects, str(tmp_path / "cp"), available_now=True).awaitTermination(240)
    opened = open_envelopes(spark.read.text(bronze))
    assert opened.where("envelope_error IS NULL").count() == 5
    refused = spark.read.json(rejects)
    assert sorted(r["reason"] for r in refused.collect()) == ["invalid_json", "prohibited_field", "source_not_allowed"]
    text = "".join(open(os.path.join(d, f), errors="ignore").read()
                   for d, _, files in os.walk(rejects) for f in files if f.endswith(".json"))
    assert "secret-device" not in text and "body_sha256" in text
    assert {"/".join(p) for r in refused.where("reason = 'prohibited_field'").collect() for p in r["issue_paths"]} == {"deviceId"}
    ingest.store_batch(spark.createDataFrame(rows, ingest.REQUESTS), 0, bronze, rejects)  # the same batch once more
    assert open_envelopes(spark.read.text(bronze)).count() == 5


def _texts_of(spark, path):
    """All Parquet cells, and all bytes of other files, below a folder."""
    said = []
    for folder, _, files in os.walk(path):
        for name in files:
            where = os.path.join(folder, name)
            said.append(str(pq.read_table(where).to_pylist()) if name.endswith(".parquet") else open(where, errors="ignore").read())
    return "".join(said)


def test_ingest_stores_no_text_that_it_refuses(spark, full_run, tmp_path, monkeypatch):
    """Neither in the tables nor, while the batch is at work, in the folder that executors share."""
    shared, kept = shared_folder(spark).removeprefix("file:"), []
    monkeypatch.setattr(staging, "remove", lambda spark, path: kept.append(path))
    private = [{**full_run[2], "deviceId": "SECRET-1"}, {**full_run[3], "context": [{"Player E-Mail": "SECRET-2"}]}, {**full_run[4], "rarity": "SECRET-3"}]
    rows = [(json.dumps(e), False, "turkiye_gateway") for e in [full_run[0], *private]] + [("{SECRET-4", False, "turkiye_gateway")]
    ingest.store_batch(spark.createDataFrame(rows, ingest.REQUESTS), 0, str(tmp_path / "bronze"), str(tmp_path / "rejects"))
    assert len(kept) == 1 and len(os.listdir(kept[0].removeprefix("file:"))) > 1
    for folder in (shared, str(tmp_path)):
        assert "SECRET" not in _texts_of(spark, folder)
    monkeypatch.undo()
    staging.remove(spark, kept[0])


def test_two_streams_keep_their_own_staged_copies(spark):
    """A block that ends in one thread leaves what another thread staged meanwhile."""
    staged, done = threading.Event(), threading.Event()
    found = {}

    def other():
        with staging.released(spark):
            rows = staging.stage(spark.range(5), "theirs")
            staged.set()
            done.wait(60)
            found["count"] = rows.count()

    thread = threading.Thread(target=other)
    with staging.released(spark):
        thread.start()
        assert staged.wait(60)
        mine = staging.stage(spark.range(3), "mine")
        assert mine.count() == 3
    done.set()
    thread.join(60)
    assert found["count"] == 5


def _rebuild(spark, bronze, base):
    ingest.start_rebuild(spark, bronze, base, available_now=True).awaitTermination(240)


def _lake(spark, base):
    rows = [(t, *r) for t in ("silver", "quarantine")
            for r in lake.read_table(spark, base, t).select("run_id", "event_id", "run_status", "received_date").collect()]
    return sorted(map(str, rows))


def _batch(spark, bronze, base, days):
    rebuild_dates(keep_deliveries(spark, bronze, base), days)
    return _lake(spark, base)


def test_streamed_rebuild_equals_batch(spark, full_run, tmp_path):
    """Three mornings: a run; a second run with one of its event ids; an earlier receipt that moves the first run."""
    bronze, base, other = (str(tmp_path / n) for n in ("bronze", "lake", "batch"))
    days = ["2026-02-28", "2026-03-01", "2026-03-02"]
    second = rename(full_run, "bb", "20000000")
    second[2]["event_id"] = full_run[2]["event_id"]
    third = rename(full_run, "cc", "40000000")
    arrivals = [
        (full_run + third, ["2026-03-01T10:00:00Z"] * 10),
        (second, ["2026-03-02T01:00:00Z"] * 5),
        (third[:1], ["2026-02-28T23:00:00Z"]),
    ]
    for events, times in arrivals:
        store(bronze_lines(spark, events, times=times), bronze)
        _rebuild(spark, bronze, base)
        assert _lake(spark, base) == _batch(spark, bronze, other, days)
    statuses = {(r["run_id"], r["run_status"], str(r["received_date"])) for t in ("silver", "quarantine")
                for r in lake.read_table(spark, base, t).collect()}
    assert statuses == {(full_run[0]["run_id"], "invalid", "2026-03-01"), (second[0]["run_id"], "invalid", "2026-03-02"),
                        (third[0]["run_id"], "valid", "2026-02-28")}


def test_broken_lines_are_listed(spark, full_run, tmp_path):
    bronze, base = str(tmp_path / "bronze"), str(tmp_path / "lake")
    store(bronze_lines(spark, full_run), bronze)
    store(spark.createDataFrame([("{broken",), ('{"bronze_record_version": 2}',)], "value string"), bronze)
    write = rebuild_silver(spark, bronze, base, "2026-03-01")
    assert (write.silver_run_count, write.quarantine_run_count, write.reject_count) == (1, 0, 2)
    rows = lake.read_rejects(spark, base).collect()
    assert sorted(r["reason"] for r in rows) == ["record_not_an_object", "unsupported_version"]
    assert all(len(r["line_sha256"]) == 64 for r in rows)


def test_staged_copies_are_removed(spark, full_run, tmp_path):
    before = {d for d in os.listdir(shared_folder(spark).removeprefix("file:"))}
    bronze, base = str(tmp_path / "bronze"), str(tmp_path / "lake")
    store(bronze_lines(spark, full_run), bronze)
    run_date(spark, bronze, base, "2026-03-01", default_catalog(spark))
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before


def test_amounts_of_any_size(spark):
    rows = spark.createDataFrame([("a", 1.25), ("a", 2.5), ("a", None), ("b", 1e25), ("b", 3e25), ("c", 1e300), ("c", 1.0), ("d", None)], "k string, v double")
    found = {r["k"]: r for r in rows.groupBy("k").agg(mean(F.col("v")).alias("m"), total(F.col("v")).alias("t")).collect()}
    assert str(found["a"]["m"]) == "1.88" and found["a"]["t"] == 3.75
    assert found["b"]["m"] == Decimal("2e25") and found["b"]["t"] == 4e25
    assert found["c"]["m"] == LARGEST and found["c"]["t"] == 1e300
    assert found["d"]["m"] is None and found["d"]["t"] is None


def test_a_huge_amount_does_not_end_the_job(spark, full_run, tmp_path):
    bronze, base = str(tmp_path / "bronze"), str(tmp_path / "lake")
    run = [{**e, "current_gold": 1e300} if "current_gold" in e else e for e in full_run]
    store(bronze_lines(spark, run), bronze)
    gold = run_date(spark, bronze, base, "2026-03-01", default_catalog(spark)).gold
    assert gold["checkpoint_metrics"].first()["average_current_gold"] == LARGEST
    assert gold["run_summary"].first()["run_status"] == "valid"
    document = daily_run_end_sums(lake.read_table(spark, base)).first()
    assert document["current_gold_sum"] == 1e300
