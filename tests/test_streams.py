"""Streams with state: repeated and late deliveries, and runs that close."""

from __future__ import annotations

from conftest import bronze_lines, rename
from pyspark.sql import functions as F

from runtrace.operators.reconstruct import reconstruct
from runtrace.sources.bronze import open_envelopes, sound_deliveries
from runtrace.sources.kept import keep_deliveries
from runtrace.streaming import runs


def _add(spark, bronze, events, times):
    bronze_lines(spark, events, times=times).coalesce(1).write.mode("append").text(bronze)


def test_kept_repeated_and_late_are_the_input(spark, full_run, tmp_path):
    bronze, path, checkpoint = (str(tmp_path / n) for n in ("bronze", "routed", "cp"))
    changed = [{**full_run[0], "game_version": "0.2.0"}]
    rounds = [
        (full_run[:3] + full_run[:1] + changed, ["2026-03-01T10:00:00Z"] * 3 + ["2026-03-01T10:05:00Z"] * 2),
        (full_run[:2], ["2026-03-04T09:00:00Z"] * 2),  # the watermark goes on to March 3rd, and what it passes is forgotten
        (full_run[3:] + full_run[1:2], ["2026-03-01T11:00:00Z", "2026-03-03T11:00:00Z", "2026-03-04T09:00:00Z"]),
    ]
    total = 0
    for events, times in rounds:
        _add(spark, bronze, events, times)
        total += len(events)
        runs.start_dedup(spark, bronze, path, checkpoint, available_now=True).awaitTermination(120)
        assert spark.read.parquet(path).count() == total
    found = sorted((r["event_id"][-1], r["route"], r["received_at"].strftime("%d %H:%M")) for r in spark.read.parquet(path).collect())
    assert found == sorted([
        ("1", "kept", "01 10:00"), ("2", "kept", "01 10:00"), ("3", "kept", "01 10:00"), ("1", "repeat", "01 10:05"), ("1", "kept", "01 10:05"),
        ("1", "repeat", "04 09:00"), ("2", "repeat", "04 09:00"), ("4", "late", "01 11:00"), ("5", "kept", "03 11:00"), ("2", "repeat", "04 09:00"),
    ])


def test_runs_close_when_their_time_is_over(spark, full_run, tmp_path):
    """Each run is judged a day after its first receipt, also by a stream that was started anew, and again if more arrives."""
    bronze, base, checkpoint = (str(tmp_path / n) for n in ("bronze", "lake", "cp"))
    cut, late = rename(full_run, "bb", "20000000"), rename(full_run, "cc", "40000000")
    rounds = [
        (full_run + cut[:3], ["2026-03-01T10:00:00Z"] * 8, {}),
        (late, ["2026-03-02T11:00:00Z"] * 5, {}),
        (rename(full_run, "dd", "50000000")[:1] + cut[3:], ["2026-03-03T20:00:00Z"] * 3, {"aa": "valid", "bb": "invalid", "cc": "valid"}),
    ]
    for number, (events, times, expected) in enumerate(rounds):
        _add(spark, bronze, events, times)
        keep_deliveries(spark, bronze, base, buckets=2)
        runs.start_closing(spark, base, checkpoint, available_now=True).awaitTermination(180)
        found = {r["run_id"][-2:]: r["run_status"] for r in runs.closed_runs(spark, base).collect()}
        if number == 2:
            assert found == expected
    batch = reconstruct(sound_deliveries(open_envelopes(spark.read.text(bronze)))).runs
    statuses = {r["run_id"][-2:]: r["run_status"] for r in batch.where(F.col("run_id").rlike("(aa|bb|cc)$")).collect()}
    assert statuses == expected
