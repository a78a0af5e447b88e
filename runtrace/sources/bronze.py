"""Bronze records: request bodies in, wrapped events out, and the scan of stored lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.functions.payload import canonical, field, fingerprint
from runtrace.functions.rules import is_object
from runtrace.functions.privacy import prohibited_paths
from runtrace.operators.validation import judge_events, private_event_id, private_issues
from runtrace.sources.staging import stage

_ZONED = r"(Z|[+-]\d\d:?\d\d)$"
_SHAPED = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d"


def zoned_timestamp(text: Column) -> Column:
    """An ISO time with an explicit offset; NULL for anything else, also for a time without one."""
    return F.when(text.rlike(_ZONED) & text.rlike(_SHAPED), text.try_cast("timestamp"))


def iso_millis(moment: Column) -> Column:
    """A moment as UTC text with milliseconds."""
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def channel_allows(channel: Column, source_type: Column) -> Column:
    """Whether a channel may deliver a source type; an unknown channel may deliver nothing."""
    pair = F.concat_ws(":", channel, source_type)
    return F.coalesce(pair.isin(*[f"{c}:{s}" for c, s in contract.CHANNEL_SOURCES]), F.lit(False))


def known_channel(channel: Column) -> Column:
    return F.coalesce(channel.isin(*sorted({c for c, _ in contract.CHANNEL_SOURCES})), F.lit(False))


def read_bodies(requests: DataFrame) -> DataFrame:
    """Decode request bodies: columns `body` and `is_base64` give `body_text`, `event` and `body_error`.

    Errors are, in this order: no body, bad base64, more than 64 KiB, and text that is not UTF-8 JSON.
    """
    raw = F.when(F.col("is_base64"), F.try_to_binary("body", F.lit("base64"))).otherwise(
        F.col("body").cast("binary")
    )
    decoded = requests.withColumn("body_bytes", raw)
    text = F.try_validate_utf8(F.col("body_bytes").cast("string"))
    decoded = decoded.withColumn("body_text", text).withColumn("event", F.try_parse_json("body_text"))
    error = (
        F.when(F.col("body").isNull(), "body_missing")
        .when(F.col("body_bytes").isNull(), "invalid_base64")
        .when(F.octet_length("body_bytes") > contract.MAX_BODY_BYTES, "body_too_large")
        .when(F.col("event").isNull(), contract.INVALID_JSON)
    )
    return decoded.withColumn("body_error", error).drop("body_bytes")


def envelopes(events: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Wrap accepted events (`event`, `ingestion_channel`) as Bronze records.

    `received_at` is a timestamp, by default the time of the batch.
    """
    moment = F.current_timestamp() if received_at is None else received_at
    return events.select(
        F.lit(contract.BRONZE_RECORD_VERSION).alias("bronze_record_version"),
        F.col("event"),
        F.struct(iso_millis(moment).alias("received_at"), F.col("ingestion_channel")).alias("metadata"),
    )


def as_lines(records: DataFrame) -> DataFrame:
    """Bronze records as one JSON text per row."""
    whole = F.struct("bronze_record_version", "event", "metadata")
    return records.select(F.to_json(whole).alias("value"))


def split_ingest(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted events and rejects of a batch of requests (`body`, `is_base64`, `ingestion_channel`).

    Rejects keep reason, paths and a digest, never the body, which may hold what the contract forbids. The batch is judged once
    and stored: accepted events, and the facts about rejects. Prohibited names are located on the way, so that no text of
    a refused request is ever stored, not even for a while.
    """
    read = judge_events(read_bodies(requests))
    source = field(F.col("event"), "source_type")
    channel = F.col("ingestion_channel")
    private = F.col("private_text").isNotNull()
    reason = (
        F.when(F.col("body_error").isNotNull(), F.col("body_error"))
        .when(private, contract.PROHIBITED_FIELD)
        .when(F.size("issues") > 0, F.get("issues", 0)["code"])
        .when(~known_channel(channel), "unsupported_channel")
        .when(~channel_allows(channel, source), "source_not_allowed")
    )
    named = F.when(F.col("body_error").isNull(), F.col("private_text"))
    read = read.withColumn("private_paths", prohibited_paths(named)).withColumn("private_id", F.when(private, private_event_id()))
    issues = F.when(F.col("private_paths").isNotNull(), private_issues(F.col("private_paths"), F.col("private_id"))).otherwise(F.col("issues"))
    refused = F.col("reason").isNotNull()
    judged = stage(
        read.withColumn("reason", reason).select(
            "reason",
            F.when(~refused, F.col("event")).alias("event"),
            F.when(refused, F.transform(issues, lambda found: found["code"])).alias("issue_codes"),
            F.when(refused, F.transform(issues, lambda found: found["path"])).alias("issue_paths"),
            "ingestion_channel",
            F.when(refused, F.sha2(F.coalesce("body", F.lit("")), 256)).alias("body_sha256"),
        ),
        "judged",
    )
    accepted = judged.where(~refused).select("event", "ingestion_channel")
    return accepted, judged.where(refused).drop("event")


def scan_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Stored lines with `received_date` from the folder names; blank lines are skipped."""
    lines = spark.read.text(path)
    return lines.where(F.trim("value") != "")


def open_envelopes(lines: DataFrame) -> DataFrame:
    """Deliveries from Bronze lines, each with `envelope_error`, which is NULL for a sound record.

    A delivery is (run_id, event_id, event_json, body_mark, received_at, ingestion_channel): the canonical text
    of the event and a mark that tells bodies apart whose numbers print alike. A broken record also has the digest
    of its line and the date of the folder it was read from, so that `broken_records` can list it.
    """
    folder = F.col("received_date").cast("date") if "received_date" in lines.columns else F.lit(None).cast("date")
    record = lines.select(F.try_parse_json("value").alias("record"), F.sha2("value", 256).alias("line"), folder.alias("folder"))
    version = F.try_variant_get("record", "$.bronze_record_version", "double")
    parts = record.select(
        "record",
        "line",
        "folder",
        version.alias("version"),
        F.try_variant_get("record", "$.event", "variant").alias("event"),
        F.try_variant_get("record", "$.metadata", "variant").alias("metadata"),
    )

    def string_member(document: str, name: str) -> Column:
        member = field(F.col(document), name, "variant")
        return F.when(F.schema_of_variant(member) == "STRING", field(F.col(document), name))

    opened = parts.select(
        "record",
        "line",
        "folder",
        "version",
        "event",
        "metadata",
        string_member("event", "run_id").alias("run_id"),
        string_member("event", "event_id").alias("event_id"),
        string_member("metadata", "received_at").alias("received_text"),
        string_member("metadata", "ingestion_channel").alias("ingestion_channel"),
    )
    opened = opened.withColumn("moment", zoned_timestamp(F.col("received_text")))

    def lacks_object(column: str) -> Column:
        return ~F.coalesce(is_object(F.col(column)), F.lit(False))

    current = F.coalesce(F.col("version") == contract.BRONZE_RECORD_VERSION, F.lit(False))
    # Whoever has all members has the objects around them, so only broken records are looked at more closely.
    complete = current
    for name in ("run_id", "event_id", "moment", "ingestion_channel"):
        complete = complete & F.col(name).isNotNull()
    error = F.when(
        ~complete,
        F.when(lacks_object("record"), "record_not_an_object")
        .when(~current, "unsupported_version")
        .when(lacks_object("event"), "no_event_object")
        .when(F.col("run_id").isNull() | F.col("event_id").isNull(), "no_run_or_event_id")
        .when(lacks_object("metadata"), "no_metadata_object")
        .when(F.col("received_text").isNull() | F.col("ingestion_channel").isNull(), "invalid_metadata")
        .otherwise("invalid_received_at"),
    )
    return opened.select(
        "run_id",
        "event_id",
        canonical(F.col("event")).alias("event_json"),
        fingerprint(F.col("event")).alias("body_mark"),
        F.col("moment").alias("received_at"),
        "ingestion_channel",
        error.alias("envelope_error"),
        F.when(error.isNotNull(), F.col("line")).alias("line_sha256"),
        F.when(error.isNotNull(), F.col("folder")).alias("folder_date"),
    )


_REJECT = ("envelope_error", "line_sha256", "folder_date")


def broken_records(opened: DataFrame) -> DataFrame:
    """The records that are no deliveries: reason, digest of the line, date of its folder. Never the line itself."""
    broken = opened.where("envelope_error IS NOT NULL")
    return broken.select(F.col("envelope_error").alias("reason"), "line_sha256", F.col("folder_date").alias("received_date"))


def sound_deliveries(opened: DataFrame, strict: bool = False) -> DataFrame:
    """Deliveries without the broken records, or with `strict` a job that fails on the first broken one.

    Give it stored deliveries: over a bare scan the filter would be pushed below the parsing and parse each line
    once more for every member it looks at.
    """
    if strict:
        failed = F.raise_error(F.concat(F.lit("broken bronze record: "), F.col("envelope_error")))
        opened = opened.withColumn(
            "run_id", F.when(F.col("envelope_error").isNotNull(), failed.cast("string")).otherwise(F.col("run_id"))
        )
        return opened.drop(*_REJECT)
    return opened.where("envelope_error IS NULL").drop(*_REJECT)
