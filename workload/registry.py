"""The queries by name, each with its check SQL where plain SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def comparable(df: DataFrame) -> DataFrame:
    """The same values in types both engines print alike."""

    def plain(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


def registry() -> dict[str, Query]:
    from workload import event_queries, gold_queries

    return {**gold_queries.QUERIES, **event_queries.QUERIES}
