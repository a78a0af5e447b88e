"""Runs from deliveries: one row per event, issues, status, owner date, and the Silver layout."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.functions.payload import each, typed, without_common_fields
from runtrace.functions.rules import ISSUE_TYPE, issue
from runtrace.operators import sequence
from runtrace.operators.ordered_scan import SLICE_BITS
from runtrace.operators.validation import judge_events, locate_private
from runtrace.schemas import SILVER
from runtrace.sources.staging import stage


@dataclass(frozen=True)
class Reconstruction:
    events: DataFrame  # one row per run and event_id
    issues: DataFrame  # sequence.ISSUE_COLUMNS
    runs: DataFrame  # one row per run: status, counters, first receipt


def utc_date(moment: Column) -> Column:
    return F.to_date(F.to_utc_timestamp(moment, F.current_timezone()))


def strict_date(value: str) -> date:
    """YYYY-MM-DD and nothing else."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        raise ValueError("a date must use YYYY-MM-DD")
    return date.fromisoformat(value)


def distinct_bodies(deliveries: DataFrame) -> DataFrame:
    """Deliveries that say the same, as one row with their number and earliest receipt."""
    return (
        deliveries.groupBy("run_id", "event_id", "event_json", "body_mark")
        .agg(F.count("*").alias("copies"), F.min(F.struct("received_at", "ingestion_channel")).alias("first"))
        .select("run_id", "event_id", "event_json", "body_mark", "copies", "first.*")
    )


def unique_events(bodies: DataFrame) -> DataFrame:
    """One row per run and event_id: the body received first, with its retries and the conflicting deliveries.

    Both groupings combine before their shuffle, so an event delivered very many times stays small.
    """
    kept = F.min(F.struct("received_at", "event_json", "body_mark", "ingestion_channel", "copies")).alias("kept")
    grouped = bodies.groupBy("run_id", "event_id").agg(kept, F.sum("copies").alias("deliveries"))
    event = F.try_parse_json("kept.event_json")
    return grouped.select(
        "run_id",
        "event_id",
        *typed(event, event_sequence="bigint", source_type="string"),
        "kept.event_json",
        F.col("kept.received_at").alias("first_received_at"),
        "kept.ingestion_channel",
        (F.col("kept.copies") - 1).alias("retries"),
        (F.col("deliveries") - F.col("kept.copies")).alias("conflicts"),
    )


def event_issues(bodies: DataFrame) -> DataFrame:
    """Contract and privacy issues of every distinct body, counted once per delivery.

    The few findings are stored; only then are the prohibited names located in the bodies that have some.
    """
    judged = judge_events(bodies.withColumn("event", F.try_parse_json("event_json")))
    judged = judged.withColumn("event_sequence", F.try_variant_get("event", "$.event_sequence", "bigint"))
    mark = issue(contract.PROHIBITED_FIELD, "", [], F.col("event_id"))
    marked = F.when(F.col("private_text").isNotNull(), F.array(mark).cast(ISSUE_TYPE)).otherwise(F.col("issues"))
    columns = ["run_id", "copies", "event_sequence"]
    found = stage(each(judged, [*columns, "private_text"], marked, "i"), "findings")
    private = found.where("private_text IS NOT NULL").withColumn("issues", F.array().cast(ISSUE_TYPE))
    located = locate_private(private).select(*columns, F.explode("issues").alias("i"))
    return (
        found.where("private_text IS NULL")
        .select(*columns, "i")
        .unionByName(located)
        .select(
            "run_id",
            F.lit("event_validation").alias("rule"),
            "i.code",
            "i.message",
            "i.path",
            "i.event_id",
            "copies",
            F.lit(0).alias("place"),
            "event_sequence",
        )
        .select(*sequence.ISSUE_COLUMNS)
    )


def _event_id_issues(rows: DataFrame, rule: str, message: str, copies: Column, place: int) -> DataFrame:
    return rows.select(
        "run_id",
        F.lit(rule).alias("rule"),
        F.lit(contract.DUPLICATE_CONFLICT).alias("code"),
        F.lit(message).alias("message"),
        F.array(F.lit("event_id")).alias("path"),
        "event_id",
        copies.alias("copies"),
        F.lit(place).alias("place"),
        F.lit(None).cast("bigint").alias("event_sequence"),
    )


def duplicate_issues(events: DataFrame) -> DataFrame:
    """One issue per delivery that contradicts the event's first body."""
    message = "the same event_id was delivered with different content"
    return _event_id_issues(events.where("conflicts > 0"), "duplicate_conflict", message, F.col("conflicts"), 1)


def shared_event_ids(ids: DataFrame) -> DataFrame:
    """Event ids that occur in more than one run, found without gathering the runs of an id."""
    ends = ids.groupBy("event_id").agg(F.min("run_id").alias("a"), F.max("run_id").alias("b"))
    return ends.where("a <> b").select("event_id")


def cross_run_issues(events: DataFrame, shared: DataFrame) -> DataFrame:
    """Every run that uses a shared event_id has one issue for it."""
    rows = events.select("run_id", "event_id").join(shared, "event_id", "left_semi")
    return _event_id_issues(
        rows, "cross_run_conflict", "the same event_id is used by different runs", F.lit(1).cast("bigint"), 10
    )


def late_issues(events: DataFrame, allowed_lateness: str = contract.ALLOWED_LATENESS) -> DataFrame:
    """Events received too long after their run's first receipt; only runs that have any are joined."""
    limit = F.expr(f"interval {allowed_lateness}")
    spans = events.groupBy("run_id").agg(
        F.min("first_received_at").alias("opened"), F.max("first_received_at").alias("last")
    )
    affected = spans.where(F.col("last") > F.col("opened") + limit).select("run_id", "opened")
    late = events.join(affected, "run_id").where(F.col("first_received_at") > F.col("opened") + limit)
    return late.select(
        "run_id",
        F.lit("late_event").alias("rule"),
        F.lit(contract.EVENT_ARRIVAL_TOO_LATE).alias("code"),
        F.lit("event arrived after the lateness window").alias("message"),
        F.array(F.lit("metadata"), F.lit("received_at")).alias("path"),
        "event_id",
        F.lit(1).cast("bigint").alias("copies"),
        F.lit(11).alias("place"),
        F.lit(None).cast("bigint").alias("event_sequence"),
    )


def run_rows(events: DataFrame, issues: DataFrame) -> DataFrame:
    """One row per run: first receipt, counters, source type of the first event, and the status its issues give."""
    opening = F.min(F.struct("event_sequence", "first_received_at", "event_json", "source_type"))
    runs = events.groupBy("run_id").agg(
        F.min("first_received_at").alias("opened"),
        opening["source_type"].alias("source_type"),
        F.count("*").alias("unique_event_count"),
        F.sum("retries").alias("exact_retry_count"),
        F.sum("conflicts").alias("conflicting_duplicate_count"),
    )
    counted = issues.groupBy("run_id").agg(
        F.sum("copies").alias("quality_issue_count"),
        F.count_if(~F.col("code").isin(*contract.INCOMPLETE_CODES)).alias("breaking"),
    )
    status = (
        F.when(F.col("quality_issue_count").isNull(), contract.VALID)
        .when(F.col("breaking") > 0, contract.INVALID)
        .otherwise(contract.INCOMPLETE)
    )
    return runs.join(counted, "run_id", "left").select(
        "run_id",
        "opened",
        utc_date(F.col("opened")).alias("received_date"),
        "source_type",
        status.alias("run_status"),
        (F.col("unique_event_count") + F.col("exact_retry_count") + F.col("conflicting_duplicate_count")).alias(
            "input_event_count"
        ),
        "unique_event_count",
        "exact_retry_count",
        "conflicting_duplicate_count",
        F.coalesce("quality_issue_count", F.lit(0)).cast("bigint").alias("quality_issue_count"),
    )


def reconstruct(
    deliveries: DataFrame,
    shared: DataFrame | None = None,
    allowed_lateness: str | None = contract.ALLOWED_LATENESS,
    bits: int = SLICE_BITS,
) -> Reconstruction:
    """Rebuild the runs of `deliveries` and judge them. Bodies feed several rules, so they are written once to the shared folder."""
    return reconstruct_bodies(stage(distinct_bodies(deliveries), "bodies"), shared, allowed_lateness, bits)


def reconstruct_bodies(
    bodies: DataFrame,
    shared: DataFrame | None = None,
    allowed_lateness: str | None = contract.ALLOWED_LATENESS,
    bits: int = SLICE_BITS,
) -> Reconstruction:
    """Rebuild runs from their distinct bodies, which are read several times: stored, or cheap to read.

    A run with any single-event issue is judged by those alone (and by shared event ids and lateness); its
    sequence rules are left out. `shared` gives event ids known to occur in several runs, for callers that pass
    only some of the runs. `allowed_lateness` None skips the lateness rule.

    The ordered events feed several rules, so they are written once to the shared folder.
    """
    if allowed_lateness is not None and not re.fullmatch(r"[1-9]\d* (second|minute|hour|day)s?", allowed_lateness):
        raise ValueError("allowed_lateness must be a positive number of seconds, minutes, hours or days")
    events = stage(unique_events(bodies), "events")
    members = sequence.typed_events(events)
    ordered = stage(sequence.ordered_events(events).drop("event_json"), "ordered")
    largest = ordered.agg(F.max("event_sequence")).first()[0]
    single = event_issues(bodies)
    together = duplicate_issues(events).unionByName(
        sequence.all_sequence_issues(members, ordered, largest, bits)
    )
    flawed = single.select("run_id").distinct()
    parts = [
        single,
        together.join(flawed, "run_id", "left_anti"),
        cross_run_issues(events, shared_event_ids(events) if shared is None else shared),
    ]
    if allowed_lateness is not None:
        parts.append(late_issues(events, allowed_lateness))
    issues = stage(reduce(DataFrame.unionByName, parts), "issues")
    return Reconstruction(events, issues, run_rows(events, issues))


def issues_json(issues: DataFrame) -> DataFrame:
    """Each run's issues as JSON, every one with code, event_id, message and path, in the order of the rules and of the run.

    Equal issues are listed as often as they occur, so a list has `quality_issue_count` entries.
    """
    order = ["place", "event_sequence", "event_id", "code", "message", "path", "copies"]
    listed = issues.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("list"))
    entry = lambda i: F.struct(i["code"].alias("code"), i["event_id"].alias("event_id"), i["message"].alias("message"), i["path"].alias("path"))
    every = F.flatten(F.transform("list", lambda i: F.array_repeat(entry(i), i["copies"].cast("int"))))
    return listed.select("run_id", F.to_json(every, {"ignoreNullFields": "false"}).alias("quality_issues_json"))


def issue_lists(issues: DataFrame) -> DataFrame:
    """An overview of each run's issues as JSON: codes with their counts, by code. Silver rows hold the whole lists of `issues_json`.

    There are as many entries as codes at most, whatever the run; issues are counted before they are gathered.
    """
    counted = issues.groupBy("run_id", "code").agg(F.sum("copies").alias("count"))
    listed = counted.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("code", "count"))).alias("list"))
    return listed.select("run_id", F.to_json("list").alias("quality_issues_json"))


def silver_rows(result: Reconstruction) -> DataFrame:
    """Events in the Silver layout, each with all issues of its run, plus the run's `quality_issue_count` and its `received_date`."""
    runs = result.runs.join(issues_json(result.issues), "run_id", "left")
    runs = runs.withColumn("quality_issues_json", F.coalesce("quality_issues_json", F.lit("[]")))
    event = F.col("event")
    events = result.events.withColumn("event", F.try_parse_json("event_json")).select(
        "run_id",
        "event_id",
        "event_sequence",
        "first_received_at",
        "ingestion_channel",
        without_common_fields(event).alias("event_payload_json"),
        *typed(
            event, event_name="string", run_elapsed_seconds="double", game_version="string", schema_version="string"
        ),
    )
    return events.join(runs, "run_id").select(*SILVER.fieldNames(), "quality_issue_count", "received_date")


def owner_dates(deliveries: DataFrame) -> DataFrame:
    """(run_id, received_date): the UTC date of each run's first receipt, from two columns combined before the shuffle."""
    opened = deliveries.groupBy("run_id").agg(F.min("received_at").alias("opened"))
    return opened.select("run_id", utc_date(F.col("opened")).alias("received_date"))


def runs_owned_by(deliveries: DataFrame, *received_dates: str) -> DataFrame:
    """The runs first received on one of some UTC dates."""
    days = [F.lit(strict_date(day)) for day in received_dates]
    return owner_dates(deliveries).where(F.col("received_date").isin(*days)).select("run_id")


def reconstruct_dates(
    deliveries: DataFrame, received_dates: list[str], allowed_lateness: str = contract.ALLOWED_LATENESS
) -> Reconstruction:
    """The runs that some dates own, with all their events whatever day they arrived.

    Only these runs are rebuilt. Their event ids are compared with those of every run in range, but only rows with one of
    these ids are grouped.
    """
    owned = deliveries.join(runs_owned_by(deliveries, *received_dates), "run_id", "left_semi")
    own_ids = owned.select("event_id").distinct()
    shared = shared_event_ids(deliveries.select("run_id", "event_id").join(own_ids, "event_id", "left_semi"))
    return reconstruct(owned, shared, allowed_lateness)


def reconstruct_date(
    deliveries: DataFrame, received_date: str, allowed_lateness: str = contract.ALLOWED_LATENESS
) -> Reconstruction:
    return reconstruct_dates(deliveries, [received_date], allowed_lateness)
