"""Streams with a state for each key: repeated deliveries, and runs that close when their time is over."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from runtrace import contract
from runtrace.operators.reconstruct import reconstruct_bodies
from runtrace.sources.bronze import open_envelopes, sound_deliveries
from runtrace.sources.kept import folder, kept, line_stream
from runtrace.sources.staging import exists, released, stage

DAY_MS = 24 * 3600 * 1000

# --- repeated deliveries ----------------------------------------------------------------------------------------

KEPT, REPEAT, LATE = "kept", "repeat", "late"
_INPUT = ("run_id string, event_id string, body binary, event_json string, received_ms bigint, ingestion_channel string, "
          "bucket bigint")
_ROUTED = "run_id string, event_id string, body string, event_json string, received_at timestamp, ingestion_channel string, route string"

#: Groups that keys are dealt to. One group of a stream's state holds many keys, so a batch calls Python a thousand times
#: at most, not once for each key. A checkpoint belongs to the number it was made with.
BUCKETS = 1024


def _bucket(key: Column, buckets: int) -> Column:
    return F.when(key.isNotNull(), F.pmod(F.xxhash64(key), F.lit(buckets)))


def _ticked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, and for each batch of them one row that only has a time."""
    for batch in batches:
        clock = pa.nulls(len(batch), pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, clock], names=[*batch.schema.names, "clock_ms"])
        if len(batch):
            tick = [pa.nulls(1, column.type) for column in batch.columns] + [pa.array([pc.max(batch.column("received_ms")).as_py()], pa.int64())]
            yield pa.RecordBatch.from_arrays(tick, names=[*batch.schema.names, "clock_ms"])


def _router(lateness_ms: int):
    """The function that keeps the state of a bucket: of each body, when it may be forgotten."""

    def route(key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if pd.isna(key[0]):
            return
        watermark = max(state.getCurrentWatermarkMs(), 0)
        until: dict[bytes, int] = {}
        if state.exists:
            bodies, times = state.get
            until = {bytes(bodies[32 * i:32 * i + 32]): t for i, t in enumerate(np.frombuffer(times, "int64").tolist())}
        if not state.hasTimedOut:
            rows = pd.concat(parts, ignore_index=True)
            moments, bodies = rows["received_ms"], rows["body"].map(bytes)
            late = moments < watermark
            new = ~late & ~bodies.isin(until.keys())
            routes = pd.Series(REPEAT, rows.index).mask(late, LATE)
            routes.loc[moments[new].groupby(bodies[new]).idxmin()] = KEPT
            for body in set(bodies[late]) & until.keys():
                until[body] = max(until[body], watermark + 1)
            for body, last in moments[~late].groupby(bodies[~late]).max().items():
                until[body] = max(until.get(body, 0), int(last) + lateness_ms, watermark + 1)
            moved = rows[["run_id", "event_id"]].assign(body=bodies.map(bytes.hex), event_json=rows["event_json"])
            moved["received_at"] = pd.to_datetime(moments, unit="ms", utc=True)
            yield moved.assign(ingestion_channel=rows["ingestion_channel"], route=routes)
        until = {body: time for body, time in until.items() if time >= watermark}
        if until:
            state.update((b"".join(until), np.array(list(until.values()), "int64").tobytes()))
            state.setTimeoutTimestamp(min(until.values()))
        elif state.exists:
            state.remove()

    return route


def deduplicated(deliveries: DataFrame, lateness_ms: int = DAY_MS, buckets: int = BUCKETS) -> DataFrame:
    """Streamed deliveries with `route`: the first of equal ones is kept, the others repeat it. Times are cut to milliseconds.

    The state of a body is forgotten once the watermark is `lateness_ms` past its last delivery; so the state is bounded by what
    arrives in that time. A delivery that is older than the watermark can't be told from a repeat any more: it is routed as late, not
    dropped. So what is kept, repeated and late together is the input.

    Spark drops rows behind the watermark before a state with an event-time timer. Here the watermark is that of rows
    of their own, one for each Arrow batch, and deliveries have no time in its column; so all of them are handed on.

    Bodies are told apart by a SHA-256 and dealt to `buckets` groups by it. A task holds one bucket's share of a batch at a time,
    and 40 bytes for each body of the bucket that is not forgotten.
    """
    known = F.concat_ws("\n", F.length("run_id"), F.length("event_id"), "run_id", "event_id", "event_json", "body_mark")
    rows = deliveries.select("run_id", "event_id", F.unhex(F.sha2(known, 256)).alias("body"), "event_json",
                             F.unix_millis("received_at").alias("received_ms"), "ingestion_channel")
    rows = rows.withColumn("bucket", _bucket(F.col("body"), buckets))
    ticked = rows.mapInArrow(_ticked, f"{_INPUT}, clock_ms bigint").withColumn("clock", F.timestamp_millis("clock_ms")).drop("clock_ms")
    return ticked.withWatermark("clock", f"{lateness_ms} milliseconds").groupBy("bucket").applyInPandasWithState(
        _router(lateness_ms), _ROUTED, "bodies binary, until binary", "append", GroupStateTimeout.EventTimeTimeout)


def start_dedup(spark: SparkSession, bronze_path: str, path: str, checkpoint: str, lateness_ms: int = DAY_MS,
                available_now: bool = False, max_files: int = 1000, every: str = "5 minutes") -> StreamingQuery:
    """Store the deliveries of new Bronze files by their route, each exactly once."""
    lines = line_stream(spark, bronze_path, max_files).where(F.trim("value") != "")
    writer = (
        deduplicated(sound_deliveries(open_envelopes(lines)), lateness_ms)
        .writeStream.format("parquet").partitionBy("route").option("path", path).option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


# --- runs that close --------------------------------------------------------------------------------------------

_CLOSED = "run_id string, cause string"
_STATUSES = "run_id string, run_status string, source_type string, received_date date, unique_event_count bigint, quality_issue_count bigint"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each run in a batch of rows the first and the last receipt: a run of any size is a few rows before the shuffle."""
    for batch in batches:
        ends = pa.Table.from_batches([batch]).group_by("run_id").aggregate([("received_ms", "min"), ("received_ms", "max")])
        for name in ("received_ms_min", "received_ms_max"):
            yield from pa.table({"run_id": ends["run_id"], "received_ms": ends[name]}).to_batches()


def _closer(open_ms: int, keep_ms: int):
    """The function that keeps the state of a bucket: of each run the first receipt, whether it was closed, and its timer."""

    def close(key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = max(state.getCurrentWatermarkMs(), 0)
        known = {run: (opened, closed, timer) for run, opened, closed, timer in json.loads(state.get[0])} if state.exists else {}
        found: list[tuple[str, str]] = []
        if not state.hasTimedOut:
            for run, first in pd.concat(parts).groupby("run_id")["received_ms"].min().items():
                opened, closed, _ = known.get(run, (int(first), False, 0))
                opened = min(opened, int(first))
                closed = closed or opened + open_ms <= watermark
                known[run] = opened, closed, max(opened + (keep_ms if closed else open_ms), watermark + 1)
                if closed:
                    found.append((run, "late"))
        for run, (opened, closed, timer) in list(known.items()):
            if timer < watermark and closed:
                del known[run]
            elif timer < watermark:
                known[run] = opened, True, max(opened + keep_ms, watermark)
                found.append((run, "time"))
        if known:
            state.update((json.dumps([(run, *values) for run, values in known.items()]),))
            state.setTimeoutTimestamp(min(timer for _, _, timer in known.values()))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(found, columns=["run_id", "cause"])

    return close


def closing_runs(bodies: DataFrame, delay: str, open_ms: int = DAY_MS, keep_days: int = contract.RETENTION_DAYS,
                 buckets: int = BUCKETS) -> DataFrame:
    """(run_id, cause) of streamed bodies: runs whose time is over, and closed runs that something more arrived for.

    Each run has one event-time timer: first at its first receipt plus `open_ms`, then at the end of retention, when it is forgotten.
    Runs are dealt to `buckets` groups; the timer of a group is the earliest of its runs'.
    """
    ends = bodies.select("run_id", F.unix_millis("received_at").alias("received_ms")).mapInArrow(_ends, "run_id string, received_ms bigint")
    timed = ends.withColumn("clock", F.timestamp_millis("received_ms")).withColumn("bucket", _bucket(F.col("run_id"), buckets))
    return timed.withWatermark("clock", delay).groupBy("bucket").applyInPandasWithState(
        _closer(open_ms, keep_days * DAY_MS), _CLOSED, "runs string", "append", GroupStateTimeout.EventTimeTimeout)


def store_closed(runs: DataFrame, number: int, base: str) -> None:
    """Judge the runs that a batch closed, by all their kept deliveries, and store their statuses under the batch's number."""
    spark = runs.sparkSession
    with released(spark):
        closed = stage(runs.select("run_id").distinct(), "closed")
        state = kept(spark, base)
        dates = state.opened().join(closed, "run_id").select(F.date_format("opened", "yyyy-MM-dd").alias("d")).distinct().collect()
        if not dates:
            return
        bodies = stage(state.bodies(sorted(row["d"] for row in dates)).join(closed, "run_id", "left_semi"), "closed-bodies")
        judged = reconstruct_bodies(bodies, state.shared_event_ids(bodies)).runs
        columns = [part.split()[0] for part in _STATUSES.split(", ")]
        judged.select(*columns, F.lit(number).cast("bigint").alias("batch")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{base}/closed_runs")


def start_closing(spark: SparkSession, base: str, checkpoint: str, delay: str = "2 hours", available_now: bool = False,
                  every: str = "5 minutes", max_files: int = 10_000) -> StreamingQuery:
    """Follow the kept deliveries and judge each run when the watermark, `delay` behind, has passed its first receipt by a day."""
    schema = kept(spark, base).table("bodies").rows().schema
    bodies = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{folder(base)}/bodies")
    writer = closing_runs(bodies, delay).writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda runs, number: store_closed(runs, number, base))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def closed_runs(spark: SparkSession, base: str) -> DataFrame:
    """The last status of every closed run."""
    path = f"{base}/closed_runs"
    if not exists(spark, path):
        return spark.createDataFrame([], _STATUSES)
    rows = spark.read.schema(f"{_STATUSES}, batch bigint").parquet(path)
    columns = [part.split()[0] for part in _STATUSES.split(", ")]
    last = rows.groupBy("run_id").agg(F.max(F.struct("batch", *columns[1:])).alias("last"))
    return last.select("run_id", *[f"last.{name}" for name in columns[1:]])
