"""The events table is read in as many even tasks as its rows need, whatever its file looks like."""

from __future__ import annotations

from pyspark.sql import functions as F

from workload import projection


def test_rows_are_dealt_evenly(spark, tmp_path):
    rows = spark.range(100_000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1_704_067_200).cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("bigint").alias("user_id"), F.lit("view").alias("event_type"), F.lit(2.0).alias("value"), F.lit('{"k": 3}').alias("props"))
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    read = projection.telemetry(spark, str(tmp_path), faults=True)
    sizes = [r["n"] for r in read.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 5 and sum(sizes) == 100_000 and max(sizes) < 25_000
    assert read.select("event_id").distinct().count() == 100_000


def test_tasks_follow_the_rows():
    assert [projection.tasks_for(n, 4) for n in (0, 1, 20_001, 10**6, 10**8)] == [1, 1, 2, 12, 500]
