"""Small helpers the operators share: tables by name, remainders of ids, and rows told apart by id and text."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the text of nothing."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def remainders(ids: list, modulus: int) -> np.ndarray:
    """The same inside a task."""
    return np.fromiter((zlib.crc32(b"" if i is None else str(i).encode()) % modulus for i in ids), np.int64, len(ids))


#: Rows of an id and a hash that are broadcast at most: some tens of MB in each executor.
FEW_KEYS = 500_000


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Document rows whose doc_id and text are not among keys (doc_id, text_hash), which should be stored. Nulls are equal."""
    few = F.broadcast(keys) if keys.count() <= FEW_KEYS else keys
    return docs.join(few, same_text(docs, few), "left_anti")


def same_text(docs: DataFrame, keys: DataFrame) -> Column:
    """Condition that a document row has the id and the text of a key; ids may be null."""
    return docs["doc_id"].eqNullSafe(keys["doc_id"]) & (F.xxhash64(docs["text"]) == keys["text_hash"])
