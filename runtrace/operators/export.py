"""Daily mergeable aggregates, the document that carries them, and its idempotent import."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.functions.numeric import total
from runtrace.functions.payload import OPTIONS_TYPE, each, field
from runtrace.functions.rules import (
    NUMBER_KINDS,
    NUMBER_SHAPE,
    fits,
    is_object,
    issue,
    kind_table,
    members,
    number_holds,
    object_shape,
    text_holds,
)
from runtrace.schemas import EXPORT, EXPORT_HEADER, EXPORT_METRICS
from runtrace.sources.staging import stage

EXPORT_KEY = ["schema_version", "bucket_date", "revision", "source_region"]


def _events(silver: DataFrame, event_name: str) -> DataFrame:
    return silver.where(F.col("event_name") == event_name).select(
        F.col("received_date").alias("bucket_date"),
        "run_elapsed_seconds",
        F.try_parse_json("event_payload_json").alias("p"),
    )


def _sum(name: str, kind: str) -> Column:
    value = field(F.col("p"), name, kind)
    return total(value) if kind == "double" else F.sum(value)


def daily_event_counts(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.col("event_name").isin(*contract.EVENT_NAMES))
        .groupBy(F.col("received_date").alias("bucket_date"), "event_name")
        .agg(F.count("*").alias("count"))
    )


def daily_option_counts(silver: DataFrame) -> DataFrame:
    options = field(F.col("p"), "options", OPTIONS_TYPE)
    return (
        each(_events(silver, "upgrade_options_shown"), ["bucket_date"], options, "option")
        .groupBy("bucket_date", "option.item_id", "option.rarity", F.col("option.slot").cast("int").alias("slot"))
        .agg(F.count("*").alias("shown_count"))
    )


def daily_selected_counts(silver: DataFrame) -> DataFrame:
    return (
        _events(silver, "upgrade_selected")
        .groupBy(
            "bucket_date",
            field(F.col("p"), "selected_item_id").alias("item_id"),
            field(F.col("p"), "selected_rarity").alias("rarity"),
            field(F.col("p"), "selected_slot", "int").alias("slot"),
        )
        .agg(F.count("*").alias("selected_count"))
    )


def daily_checkpoint_sums(silver: DataFrame) -> DataFrame:
    """Counts and sums only, so days, revisions and sources can be added up again."""
    sums = {
        "player_level": "bigint",
        "current_xp": "double",
        "xp_to_next_level": "double",
        "hp_percent": "double",
        "total_kills": "bigint",
        "current_gold": "double",
    }
    return (
        _events(silver, "run_checkpoint")
        .groupBy("bucket_date", field(F.col("p"), "checkpoint_number", "int").alias("checkpoint_number"))
        .agg(F.count("*").alias("checkpoint_count"), *[_sum(n, kind).alias(f"{n}_sum") for n, kind in sums.items()])
    )


def daily_run_end_sums(silver: DataFrame) -> DataFrame:
    return (
        _events(silver, "run_ended")
        .groupBy("bucket_date", field(F.col("p"), "end_reason").alias("end_reason"))
        .agg(
            F.count("*").alias("end_count"),
            total(F.col("run_elapsed_seconds")).alias("run_duration_seconds_sum"),
            _sum("final_level", "bigint").alias("final_level_sum"),
            _sum("total_kills", "bigint").alias("total_kills_sum"),
            _sum("current_gold", "double").alias("current_gold_sum"),
        )
    )


def export_documents(silver: DataFrame, revision: int = 1, data_class: str = "SYNTHETIC_TEST") -> DataFrame:
    """One document per day: header columns and `metrics`, five sorted arrays.

    Arrays hold one entry per item, rarity and slot, per checkpoint number, or per enum value of a day: the
    aggregation has already happened when they are gathered.
    """
    if data_class not in contract.EXPORT_DATA_CLASSES:
        raise ValueError(f"unknown data class {data_class!r}")
    daily = {
        "event_counts": daily_event_counts(silver),
        "upgrade_option_counts": daily_option_counts(silver),
        "upgrade_selected_counts": daily_selected_counts(silver),
        "run_checkpoint_counts": daily_checkpoint_sums(silver),
        "run_end_counts": daily_run_end_sums(silver),
    }
    documents = None
    for name, rows in daily.items():
        layout = EXPORT_METRICS[name]
        entry = F.struct(*[F.col(part.name).cast(part.dataType).alias(part.name) for part in layout])
        gathered = rows.groupBy("bucket_date").agg(F.sort_array(F.collect_list(entry)).alias(name))
        documents = gathered if documents is None else documents.join(gathered, "bucket_date", "left")
    arrays = [
        F.coalesce(F.col(name), F.array().cast(EXPORT["metrics"].dataType[name].dataType)).alias(name)
        for name in daily
    ]
    return documents.select(
        F.lit(contract.EXPORT_SCHEMA_VERSION).alias("schema_version"),
        F.date_format("bucket_date", "yyyy-MM-dd").alias("bucket_date"),
        F.lit(revision).cast("bigint").alias("revision"),
        F.lit(contract.EXPORT_SOURCE_REGION).alias("source_region"),
        F.lit(contract.EXPORT_DESTINATION_REGION).alias("destination_region"),
        F.lit(contract.EXPORT_PRIVACY_MODE).alias("privacy_mode"),
        F.lit(data_class).alias("data_class"),
        F.struct(*arrays).alias("metrics"),
    )


def document_text(documents: DataFrame, *columns: str) -> DataFrame:
    """Documents as JSON text, one per row, beside some of their columns."""
    return documents.select(F.to_json(F.struct(*EXPORT_HEADER, "metrics")).alias("value"), *columns)


_HEADER_KINDS = {
    "schema_version": "export_schema",
    "bucket_date": "date",
    "revision": "ordinal",
    "source_region": "source_region",
    "destination_region": "destination_region",
    "privacy_mode": "privacy_mode",
    "data_class": "data_class",
}
_ENTRY_KINDS = {
    "event_name": "event_name",
    "item_id": "stable_id",
    "rarity": "rarity",
    "slot": "slot",
    "checkpoint_number": "ordinal",
    "end_reason": "end_reason",
    "current_xp_sum": "amount",
    "xp_to_next_level_sum": "amount",
    "hp_percent_sum": "amount",
    "current_gold_sum": "amount",
    "run_duration_seconds_sum": "amount",
}


def _names(values) -> Column:
    return F.array(*[F.lit(value) for value in values])


def validate_documents(texts: DataFrame) -> DataFrame:
    """Documents (`value` as JSON text) with `issues`: what is missing, unknown or out of range."""
    code, nobody = contract.SCHEMA_INVALID, F.lit(None).cast("string")
    read = texts.withColumn("document", F.try_parse_json("value"))
    read = read.withColumn("top", F.when(is_object(F.col("document")), members(F.col("document"))))
    read = read.withColumn("inner", F.when(is_object(F.col("top")["metrics"]), members(F.col("top")["metrics"])))

    def missing(entries: Column, wanted, path: list[str]) -> Column:
        return F.transform(
            F.array_except(_names(wanted), F.map_keys(entries)),
            lambda name: issue(code, F.concat(name, F.lit(" is required")), path, nobody),
        )

    def unknown(entries: Column, known, path: list[str]) -> Column:
        return F.transform(
            F.array_except(F.map_keys(entries), _names(known)),
            lambda name: issue(code, F.concat(name, F.lit(" is not part of the contract")), path, nobody),
        )

    top, inner = F.col("top"), F.col("inner")
    header = F.transform(
        F.filter(
            F.map_entries(top),
            lambda e: e["key"].isin(*_HEADER_KINDS)
            & ~fits(F.try_element_at(kind_table(_HEADER_KINDS), e["key"]), e["value"], nested=False),
        ),
        lambda e: issue(code, F.concat(e["key"], F.lit(" is not a contract value")), F.array(e["key"]), nobody),
    )

    def entries_hold(listed: Column, names: list[str]) -> Column:
        """Every entry has exactly these members, of the right type and in range; no entries is fine."""
        kinds = {part: _ENTRY_KINDS.get(part, "count") for part in names}
        shape = f"^ARRAY<(?:VOID|{object_shape(kinds, tuple(kinds), whole=NUMBER_SHAPE)})>$"
        layout = ",".join(f"{part}:{'double' if kind in NUMBER_KINDS else 'string'}" for part, kind in kinds.items())
        typed = F.try_variant_get(listed, "$", f"array<struct<{layout}>>")

        def holds(entry: Column) -> Column:
            checks = [
                number_holds(kind, entry[part]) & (F.lit(kind == "amount") | (entry[part] % 1 == 0))
                if kind in NUMBER_KINDS
                else text_holds(kind, entry[part])
                for part, kind in kinds.items()
            ]
            return F.coalesce(reduce(lambda a, b: a & b, checks), F.lit(False))

        return F.schema_of_variant(listed).rlike(shape) & F.forall(typed, holds)

    bodies = []
    for name, layout in EXPORT_METRICS.items():
        listed = F.try_element_at(inner, F.lit(name))
        sound = entries_hold(listed, layout.fieldNames())
        problem = issue(code, f"{name} has an entry outside the contract", ["metrics", name], nobody)
        bodies.append(F.when(listed.isNotNull() & ~F.coalesce(sound, F.lit(False)), problem))
    shape = issue(code, "metrics must be an object", ["metrics"], nobody)
    known = [*_HEADER_KINDS, "metrics"]
    issues = F.when(top.isNull(), F.array(issue(code, "a document must be a JSON object", [], nobody))).otherwise(
        F.concat(
            missing(top, known, []),
            unknown(top, known, []),
            header,
            F.when(inner.isNull() & F.map_contains_key(top, "metrics"), F.array(shape)).otherwise(F.array()),
            F.when(inner.isNull(), F.array()).otherwise(
                F.concat(
                    missing(inner, EXPORT_METRICS, ["metrics"]),
                    unknown(inner, EXPORT_METRICS, ["metrics"]),
                    F.array_compact(F.array(*bodies)),
                )
            ),
        )
    )
    return read.select(*texts.columns, issues.alias("issues"))


def import_decisions(validated: DataFrame, imported: DataFrame) -> DataFrame:
    """Typed documents with `outcome` (IMPORTED, DUPLICATE_IGNORED or REJECTED) and how many `documents` met it.

    A key that was imported before, or that another document of the batch takes first, is ignored whole. Equal
    documents are counted before anything else; documents of one key are compared by their text, so the choice
    does not depend on input order.
    """
    checked = validated.select("value", (F.size("issues") > 0).alias("broken"))
    checked = stage(checked.groupBy("value", "broken").agg(F.count("*").alias("documents")), "documents")
    typed = checked.withColumn("d", F.from_json("value", EXPORT)).select("d.*", "value", "broken", "documents")
    sound = typed.where("NOT broken")
    known = imported.select(*EXPORT_KEY).distinct().withColumn("known", F.lit(True))
    first = sound.groupBy(*EXPORT_KEY).agg(F.min("value").alias("first_value"))
    judged = sound.join(first, EXPORT_KEY).join(known, EXPORT_KEY, "left")
    fresh = F.col("known").isNull() & (F.col("value") == F.col("first_value"))
    taken, rest = F.when(fresh, 1).otherwise(0), F.col("documents") - F.when(fresh, 1).otherwise(0)

    def outcome(name: str, count: Column) -> Column:
        return F.when(count > 0, F.struct(F.lit(name).alias("outcome"), count.cast("bigint").alias("documents")))

    outcomes = F.inline(F.array_compact(F.array(outcome("IMPORTED", taken), outcome("DUPLICATE_IGNORED", rest))))
    columns = [*EXPORT_HEADER, "metrics"]
    rejected = typed.where("broken").select(*columns, F.lit("REJECTED").alias("outcome"), "documents")
    return judged.select(*columns, outcomes).unionByName(rejected)


def exploded(documents: DataFrame, metric: str) -> DataFrame:
    """One metric array of imported documents as rows under the document key."""
    names = EXPORT_METRICS[metric].fieldNames()
    rows = documents.select(
        "schema_version", "bucket_date", "revision", F.explode(F.col(f"metrics.{metric}")).alias("entry")
    )
    columns = [F.col(f"entry.{name}") for name in names]
    if metric == "event_counts":
        columns = [F.col("entry.event_name"), F.col("entry.count").alias("event_count")]
    return rows.select("schema_version", "bucket_date", "revision", *columns)


def latest_revision(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of the highest revision of each key, by default of each day."""
    keys = keys or ("bucket_date",)
    newest = rows.groupBy(*keys).agg(F.max("revision").alias("revision"))
    return rows.join(newest, [*keys, "revision"], "left_semi")
