"""Imported export documents as six stored tables: a header per document and a row per entry of its five metrics.

An import decides by key which documents are new, writes their rows into a folder of its own, and puts all six tables in
force with one version pointer. A document whose key is stored, or is taken first by another document of the same import, changes nothing; so an
import that is repeated, also after a stop on the way, leaves the same tables. `latest` names the highest revision of each
day and is replaced in the same commit, so nobody has to look for it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtrace.operators.export import EXPORT_KEY, document_text, exploded, import_decisions, validate_documents
from runtrace.schemas import EXPORT, EXPORT_HEADER, EXPORT_METRICS
from runtrace.sources import versions
from runtrace.sources.staging import remove, stage

#: Commits that are read one by one; with more of them an import writes all rows anew, as one.
MOST_COMMITS = 32

HEADER = "exports"
_HEADER_COLUMNS = [name for name in EXPORT_HEADER if name != "privacy_mode"]
_DAY = ["schema_version", "bucket_date", "source_region"]


def _layouts() -> dict[str, T.StructType]:
    document = [EXPORT["schema_version"], EXPORT["bucket_date"], EXPORT["revision"]]
    entries = {
        metric: T.StructType([*document, *[T.StructField("event_count" if part.name == "count" else part.name, part.dataType) for part in layout]])
        for metric, layout in EXPORT_METRICS.items()
    }
    return {
        HEADER: T.StructType([EXPORT[name] for name in _HEADER_COLUMNS]),
        **entries,
        "latest": T.StructType([*[EXPORT[name] for name in _DAY], EXPORT["revision"]]),
    }


LAYOUTS = _layouts()
TABLES = [name for name in LAYOUTS if name != "latest"]


def _root(base: str) -> str:
    return f"{base}/imports"


def read_import(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One of the tables as of the last commit."""
    content = versions.latest(spark, _root(base))[1]
    commits = content.get("commits", [])
    commits = commits[-1:] if table == "latest" else commits
    if not commits:
        return spark.createDataFrame([], LAYOUTS[table])
    return spark.read.schema(LAYOUTS[table]).parquet(*[f"{_root(base)}/{commit}/{table}" for commit in commits])


def latest_rows(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Rows of the highest revision of each day."""
    newest = read_import(spark, base, "latest").select("schema_version", "bucket_date", "revision")
    return read_import(spark, base, table).join(newest, ["schema_version", "bucket_date", "revision"], "left_semi")


def import_documents(spark: SparkSession, texts: DataFrame, base: str) -> DataFrame:
    """Import documents (`value` as JSON text); returns what became of them by key: outcome and number of documents.

    Raises VersionConflictError if another import committed meanwhile; nothing is stored then, and the import may be repeated.
    The decisions are staged; the caller may remove them (`released`).
    """
    number, content = versions.latest(spark, _root(base))
    decided = stage(import_decisions(validate_documents(texts), read_import(spark, base, HEADER)), "decisions")
    fresh = decided.where("outcome = 'IMPORTED'")
    if not fresh.isEmpty():
        _commit(spark, fresh, base, number, content)
    return decided.groupBy(*EXPORT_KEY, "outcome").agg(F.sum("documents").alias("documents"))


def _commit(spark: SparkSession, fresh: DataFrame, base: str, number: int, content: dict) -> None:
    """Store new documents as one commit. Past MOST_COMMITS it holds all rows, and the commits before it are removed a round later."""
    root, commits, former = _root(base), content.get("commits", []), content.get("former", [])
    commit = f"c{number + 1:06d}-{uuid.uuid4().hex[:8]}"
    rows = {HEADER: fresh.select(*_HEADER_COLUMNS), **{metric: exploded(fresh, metric) for metric in EXPORT_METRICS}}
    whole = len(commits) >= MOST_COMMITS
    days = read_import(spark, base, "latest").unionByName(fresh.select(*_DAY, "revision"))
    rows["latest"] = days.groupBy(*_DAY).agg(F.max("revision").alias("revision"))
    for table, new in rows.items():
        new = new.select(*LAYOUTS[table].fieldNames())
        if whole and table != "latest":
            new = read_import(spark, base, table).unionByName(new)
        new.write.parquet(f"{root}/{commit}/{table}")
    after = {"commits": [commit], "former": commits} if whole else {"commits": [*commits, commit], "former": former}
    try:
        versions.publish(spark, root, number + 1, after)
    except versions.VersionConflictError:
        remove(spark, f"{root}/{commit}")
        raise
    for old in versions.numbers(spark, root)[:-2]:
        versions.forget(spark, root, old)
    for old in former if whole else []:
        remove(spark, f"{root}/{old}")


def save_documents(documents: DataFrame, path: str) -> None:
    """Store export documents, one folder for each day and revision; a rerun replaces those of its days and revisions."""
    (
        document_text(documents, "bucket_date", "revision")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket_date", "revision").text(path)
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The stored documents as JSON texts, one per row."""
    return spark.read.option("recursiveFileLookup", "true").text(path)
