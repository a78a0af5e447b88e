"""The state of a stream is kept by bucket: many bodies and runs make few groups, and each still has its own timer."""

from __future__ import annotations

from conftest import bronze_lines, rename
from pyspark.sql import functions as F

from runtrace.sources.bronze import open_envelopes, sound_deliveries
from runtrace.streaming import runs

LINES = "value string"


def _write(spark, path, events, times):
    bronze_lines(spark, events, times=times).coalesce(1).write.mode("append").text(path)


def _many(full_run, count):
    return [event for i in range(count) for event in rename(full_run, f"{i:x}", f"{i:08x}")]


def _groups(query):
    return max(step["stateOperators"][0]["numRowsTotal"] for step in query.recentProgress)


def test_many_bodies_are_few_groups(spark, full_run, tmp_path):
    """Routes are those of a plain loop over the deliveries; bodies of one bucket are told apart."""
    bronze, path, checkpoint = (str(tmp_path / n) for n in ("bronze", "routed", "cp"))
    events = _many(full_run, 40)
    rounds = [(events + events[:50], ["2026-03-01T10:00:00Z"] * 200 + ["2026-03-01T09:00:00Z"] * 50),
              (events[40:60], ["2026-03-01T12:00:00Z"] * 20)]
    for sent, times in rounds:
        _write(spark, bronze, sent, times)
        query = (
            runs.deduplicated(sound_deliveries(open_envelopes(spark.readStream.schema(LINES).text(bronze))), buckets=3)
            .writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination(120)
        assert 0 < _groups(query) <= 3
    rows = spark.read.parquet(path)
    assert {r["route"]: r["count"] for r in rows.groupBy("route").count().collect()} == {"kept": 200, "repeat": 70}
    first = rows.where("route = 'kept'").groupBy(F.hour("received_at").alias("h")).count().collect()
    assert {r["h"]: r["count"] for r in first} == {9: 50, 10: 150}
    assert rows.where("route = 'kept'").select("run_id", "event_id").distinct().count() == 200


def test_many_runs_are_few_groups(spark, full_run, tmp_path):
    """Runs of one bucket open on different days: each is closed by its own time, and once more by what is late."""
    source, checkpoint = str(tmp_path / "bodies"), str(tmp_path / "cp")
    causes = []

    def note(batch, number):
        causes.extend((r["run_id"], r["cause"]) for r in batch.collect())

    rounds = [[(f"a{i}", "2026-03-01 10:00:00") for i in range(30)] + [(f"b{i}", "2026-03-02 09:00:00") for i in range(30)],
              [("c", "2026-03-02 13:00:00")], [("a1", "2026-03-02 12:30:00"), ("c", "2026-03-03 12:00:00")]]
    groups = 0
    for rows in rounds:
        frame = spark.createDataFrame(rows, "run_id string, t string").select("run_id", F.col("t").cast("timestamp").alias("received_at"))
        frame.coalesce(1).write.mode("append").parquet(source)
        bodies = spark.readStream.schema("run_id string, received_at timestamp").parquet(source)
        query = runs.closing_runs(bodies, "2 hours", buckets=2).writeStream.foreachBatch(note).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination(120)
        groups = max(groups, _groups(query))
    assert 0 < groups <= 2
    assert sorted(causes) == sorted([(f"a{i}", "time") for i in range(30)] + [("a1", "late")]
                                    + [(f"b{i}", "time") for i in range(30)])
