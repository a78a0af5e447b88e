"""New runs from known ones: fresh identifiers, the same links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace.functions.payload import field, fingerprint
from runtrace.operators.reconstruct import reconstruct


class ScenarioError(ValueError):
    """A template or generated run does not meet the contract."""


def derived_uuid(kind: str, copy: Column, *parts: Column) -> Column:
    """A UUID computed from what it stands for, so that a recomputed task gives the same one."""
    digest = F.md5(F.concat_ws("|", F.lit(kind), copy.cast("string"), *parts).cast("binary"))
    groups = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4))]
    tail = [F.substring(digest, start, length) for start, length in ((14, 3), (18, 3), (21, 12))]
    return F.concat_ws(
        "-", *groups, F.concat(F.lit("4"), tail[0]), F.concat(F.lit("8"), tail[1]), tail[2]
    )


def rekeyed(events: DataFrame, copies: int = 1, salt: str = "scenario") -> DataFrame:
    """`copies` new runs of every run in `events` (a VARIANT column `event`).

    Within a copy, equal event ids stay equal (so retries stay retries), choice ids keep linking shown and
    selected, and every event is marked as a controlled scenario. No shuffle is needed. What all copies of an event share is written
    before they are made.
    """
    old = F.col("event")
    replaced = ("run_id", "event_id", "source_type", "choice_id")
    entries = F.from_json(F.to_json(old), "map<string,variant>")
    shared = events.select(
        field(old, "run_id").alias("run"),
        field(old, "event_id").alias("own"),
        field(old, "choice_id").alias("choice"),
        (F.schema_of_variant(field(old, "choice_id", "variant")) == "STRING").alias("linked"),
        F.to_json(F.map_filter(entries, lambda key, _: ~key.isin(*replaced))).alias("kept"),
    )
    many = shared.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    copy = F.concat_ws("|", F.lit(salt), F.col("copy").cast("string"))
    identity = F.to_json(
        F.struct(
            derived_uuid("run", copy, F.col("run")).alias("run_id"),
            derived_uuid("event", copy, F.col("run"), F.col("own")).alias("event_id"),
            F.lit("CONTROLLED_SCENARIO").alias("source_type"),
            F.when(F.col("linked"), derived_uuid("choice", copy, F.col("run"), F.col("choice"))).alias("choice_id"),
        )
    )
    # Two JSON objects without common names, written as one.
    joined = F.concat(F.rtrim(identity, F.lit("}")), F.lit(","), F.ltrim("kept", F.lit("{")))
    return many.select(F.parse_json(F.when(F.col("kept") == "{}", identity).otherwise(joined)).alias("event"), "copy")


def controlled_scenarios(events: DataFrame, copies: int = 1, salt: str = "scenario") -> DataFrame:
    """`rekeyed`, refused unless every template run and every generated run is valid."""
    generated = rekeyed(events, copies, salt)
    for name, rows in (("template", events), ("generated", generated)):
        bad = reconstruct(as_deliveries(rows), allowed_lateness=None).runs.where("run_status <> 'valid'").first()
        if bad is not None:
            raise ScenarioError(f"{name} run {bad['run_id']} is {bad['run_status']}")
    return generated


def as_deliveries(events: DataFrame) -> DataFrame:
    """Bare events as deliveries of one moment."""
    event = F.col("event")
    return events.select(
        field(event, "run_id").alias("run_id"),
        field(event, "event_id").alias("event_id"),
        F.to_json(event).alias("event_json"),
        fingerprint(event).alias("body_mark"),
        F.timestamp_seconds(F.lit(0)).alias("received_at"),
        F.lit("scenario_generator").alias("ingestion_channel"),
    )
