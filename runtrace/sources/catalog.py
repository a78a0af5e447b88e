"""The item dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.schemas import ITEM_CATALOG

CATALOG_KEY = ["game_version", "choice_source", "item_id"]


def default_catalog(spark: SparkSession) -> DataFrame:
    """The 24 known items of the catalogued game version."""
    rows = [(contract.ITEM_CATALOG_VERSION, *row) for row in contract.item_rows()]
    return spark.createDataFrame(rows, ITEM_CATALOG)


def for_versions(versions: DataFrame) -> DataFrame:
    """The known items repeated for every game version in `versions`."""
    names = [field.name for field in ITEM_CATALOG.fields[1:]]

    def item(row: tuple) -> Column:
        return F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row, strict=True)])

    items = F.array(*[item(row) for row in contract.item_rows()])
    distinct = versions.select("game_version").where("game_version IS NOT NULL").distinct()
    return distinct.select("game_version", F.inline(items))


def load_catalog(spark: SparkSession, path: str, file_format: str = "parquet", **options) -> DataFrame:
    """A catalog kept outside the code, in the same nine columns."""
    return spark.read.schema(ITEM_CATALOG).options(**options).format(file_format).load(path)


def duplicate_items(catalog: DataFrame) -> DataFrame:
    """Catalog keys that occur more than once; Gold joins require none."""
    return catalog.groupBy(*CATALOG_KEY).agg(F.count("*").alias("row_count")).where("row_count > 1")
