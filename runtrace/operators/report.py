"""The bounded report dataset: six checked sections of Gold rows in one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.operators.reconstruct import strict_date
from runtrace.schemas import GOLD

# Section -> (Gold table, columns, most rows allowed).
SECTIONS = {
    "run_quality": ("run_quality", list(GOLD["run_quality"]), 4),
    "run_outcomes": ("run_outcome", list(GOLD["run_outcome"]), 6),
    "checkpoint_metrics": ("checkpoint_metrics", list(GOLD["checkpoint_metrics"]), 50),
    "upgrade_funnel": ("upgrade_funnel", list(GOLD["upgrade_funnel"]), 100),
    "run_progression": (
        "run_progression",
        ["game_version", "checkpoint_number", "started_run_count", "reached_run_count", "reach_percentage",
         "step_dropoff_percentage"],
        20,
    ),
    "item_performance_summary": ("item_performance_summary", list(GOLD["item_performance_summary"]), 20),
}


class ReportInputError(ValueError):
    """A section has other columns, too many rows or values the report may not hold."""


def steepest_dropoffs(run_progression: DataFrame, rows: int = 20) -> DataFrame:
    """The steps that lose most runs."""
    return run_progression.select(*SECTIONS["run_progression"][1]).orderBy(
        F.desc_nulls_last("step_dropoff_percentage"), "game_version", "checkpoint_number"
    ).limit(rows)


def leading_items(item_performance: DataFrame, rows: int = 20) -> DataFrame:
    """Items with observed outcomes: those with enough of them first, then by how many runs picked them."""
    thin = F.when(F.col("analysis_status") == "DESCRIPTIVE_ONLY", 0).otherwise(1)
    return (
        item_performance.where("outcome_observed_run_count > 0")
        .select(*SECTIONS["item_performance_summary"][1])
        .orderBy(thin, F.desc_nulls_last("selected_run_count"), "game_version", "item_id", "choice_source")
        .limit(rows)
    )


def _value_error(name: str, kind: str) -> Column:
    value = F.col(name)
    bad = value.isNull()
    if kind == "string":
        bad = bad | ~F.length(value).between(1, contract.REPORT_MAX_TEXT)
    elif kind in ("double", "float"):
        bad = bad | F.isnan(value) | (F.abs(value) == float("inf"))
    elif kind == "boolean" and name != "rarity_scaled":
        bad = F.lit(True)
    return F.when(bad, F.lit(name))


def section_errors(section: str, rows: DataFrame) -> DataFrame:
    """(section, problem) for values a section may not hold, and for too many rows.

    One row more than allowed is enough to know, so at most that many are read. Checked here, never cut off.
    """
    _, columns, most = SECTIONS[section]
    named = rows.toDF(*[name.lower() for name in rows.columns])
    if set(named.columns) != set(columns):
        unexpected, missing = sorted(set(named.columns) - set(columns)), sorted(set(columns) - set(named.columns))
        raise ReportInputError(f"{section} columns differ: unexpected={unexpected}, missing={missing}")
    probe = named.select(*columns).limit(most + 1)
    problems = F.array_compact(F.array(*[_value_error(name, kind) for name, kind in probe.dtypes]))
    values = probe.select(F.explode(problems).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    values = values.select(F.concat("name", F.lit(" has a value that is not allowed")).alias("problem"))
    long = probe.agg(F.count("*").alias("n")).where(F.col("n") > most)
    long = long.select(F.lit(f"more than {most} rows").alias("problem"))
    return values.unionByName(long).select(F.lit(section).alias("section"), "problem")


def section_rows(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six sections from the Gold tables; two of them are top lists by design."""
    sections = {
        name: gold[table].select(*columns) for name, (table, columns, _) in SECTIONS.items()
    }
    sections["run_progression"] = steepest_dropoffs(gold["run_progression"])
    sections["item_performance_summary"] = leading_items(gold["item_performance_summary"])
    return sections


def _entry(rows: DataFrame, columns: list[str]) -> Column:
    """Numbers as JSON numbers: whole ones without decimals, others as doubles; columns in name order."""
    kinds = dict(rows.dtypes)

    def plain(name: str) -> Column:
        return (F.col(name).cast("double") if kinds[name].startswith("decimal") else F.col(name)).alias(name)

    return F.struct(*[plain(name) for name in sorted(columns)])


def _document(report_date: str, sections: dict[str, DataFrame]) -> DataFrame:
    """One row: report_date, `document` as JSON text and its size.

    Each section is gathered from at most its allowed number of rows plus one; `checked_report` refuses the
    document when the extra row is there.
    """
    day = strict_date(report_date).isoformat()
    document = None
    for name, (_, columns, most) in SECTIONS.items():
        rows = sections[name].toDF(*[c.lower() for c in sections[name].columns])
        rows = rows.select(*columns).limit(most + 1)
        gathered = rows.agg(F.sort_array(F.collect_list(_entry(rows, columns))).alias(name))
        gathered = gathered.withColumn("report_date", F.lit(day))
        document = gathered if document is None else document.join(gathered, "report_date")
    text = F.to_json(
        F.struct(
            F.lit(contract.REPORT_SCHEMA_VERSION).alias("schema_version"),
            F.col("report_date"),
            F.struct(*SECTIONS).alias("metrics"),
        )
    )
    return document.select("report_date", text.alias("document")).withColumn(
        "document_bytes", F.octet_length("document").cast("bigint")
    )


def report_errors(sections: dict[str, DataFrame]) -> DataFrame:
    errors = None
    for name in SECTIONS:
        found = section_errors(name, sections[name])
        errors = found if errors is None else errors.unionByName(found)
    return errors


def checked_report(report_date: str, sections: dict[str, DataFrame], most_bytes: int = contract.REPORT_MAX_BYTES) -> DataFrame:
    """The document, once its sections and its size are known to be within the contract, or within another size."""
    found = [tuple(row) for row in report_errors(sections).collect()]
    if found:
        raise ReportInputError(f"report input is not allowed: {found}")
    document = _document(report_date, sections)
    size = document.select("document_bytes").first()[0]
    if size > most_bytes:
        raise ReportInputError(f"report input of {size} bytes exceeds {most_bytes}")
    return document
