"""Typed access to the JSON payload of an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace import contract

OPTIONS_TYPE = "array<struct<slot:bigint,item_id:string,rarity:string>>"


def field(document: Column, name: str, kind: str = "string") -> Column:
    """One member of a VARIANT object, NULL when absent or of an incompatible type."""
    return F.try_variant_get(document, f"$.{name}", kind)


def typed(document: Column, **kinds: str) -> list[Column]:
    return [field(document, name, kind).alias(name) for name, kind in kinds.items()]


def with_members(rows: DataFrame, document: str, **kinds: str) -> DataFrame:
    """Rows without a VARIANT column, with its members as `typed` gives them, from one pass over the object instead of one for each."""
    layout = ",".join(f"{name}:{kind}" for name, kind in kinds.items())
    others = [name for name in rows.columns if name != document]
    found = rows.select(*others, F.try_variant_get(document, F.lit("$"), f"struct<{layout}>").alias("members"))
    return found.select(*others, *[F.col("members")[name].alias(name) for name in kinds])


def canonical(document: Column) -> Column:
    """Text that is equal for documents differing only in key order or white space."""
    return F.to_json(document)


def fingerprint(document: Column) -> Column:
    """Tells apart numbers the canonical text renders alike, such as 60 and 60.0."""
    return F.md5(F.schema_of_variant(document).cast("binary"))


def product_events(silver: DataFrame, event_name: str, *columns: str) -> DataFrame:
    """Product events of one type with the named columns and the parsed payload `p`.

    The filter stands on stored columns, so it reaches the Parquet scan and other events are never parsed.
    """
    return silver.where(
        (F.col("source_type") == contract.PRODUCT_SOURCE) & (F.col("event_name") == event_name)
    ).select(*columns, F.try_parse_json("event_payload_json").alias("p"))


def without_common_fields(event: Column) -> Column:
    """The event-specific part of a VARIANT event as sorted-key JSON text.

    Absent optional members are left out. The event is one parsed from canonical text, so its numbers print as they stand there.
    """
    everything = F.try_variant_get(event, F.lit("$"), "map<string,variant>")
    own = F.map_filter(everything, lambda key, _: ~key.isin(*contract.COMMON_FIELDS))
    return F.to_json(own)


def each(rows: DataFrame, keep: list[str], array: Column, alias: str) -> DataFrame:
    """One row per element of an array, as `explode` gives them.

    `explode` lets Spark drop empty arrays early, for which it computes the array a second time below; the outer
    form with a test on the position computes it once. That matters where the array is the result of the work.
    It is a column first: of an expression, `explode` would find out the type anew for each row.
    """
    listed = rows.select(*keep, array.alias("elements"))
    spread = listed.select(*keep, F.posexplode_outer("elements").alias("position", alias))
    return spread.where("position IS NOT NULL").drop("position")
