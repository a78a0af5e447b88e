"""Gold by date, the gate that counts while it writes, files of bounded number, and pruned date folders."""

from __future__ import annotations

import json
import os
import shutil

import pytest
from conftest import bronze_lines, rename
from pyspark.sql import functions as F

from runtrace.operators import gold_items, gold_states
from runtrace.operators.quality import ObservedGate, QualityGateError
from runtrace.plans.run_date import gold_tables, rebuild_dates
from runtrace.schemas import GOLD, gold_columns
from runtrace.sources import lake
from runtrace.sources.catalog import default_catalog
from runtrace.sources.kept import keep_deliveries
from runtrace.sources.staging import stage
from runtrace.streaming import ingest

DAYS = ["2026-03-01", "2026-03-02"]


_MADE: list[str] = []


@pytest.fixture
def two_days(spark, full_run, tmp_path, tmp_path_factory):
    """A lake of two dates with two runs each, a copy for every test."""
    if not _MADE:
        made = tmp_path_factory.mktemp("two-days")
        for i, day in enumerate(DAYS):
            runs = [e for k in range(2) for e in rename(full_run, f"{i}{k}", f"3{i}{k}00000")]
            bronze_lines(spark, runs, times=[f"{day}T10:00:00Z"] * len(runs)).write.mode("append").text(str(made / "bronze"))
        rebuild_dates(keep_deliveries(spark, str(made / "bronze"), str(made / "lake")), DAYS)
        _MADE.append(str(made / "lake"))
    shutil.copytree(f"{_MADE[0]}/silver", tmp_path / "lake" / "silver")
    return str(tmp_path / "lake")


def test_a_refresh_reads_the_folders_of_its_dates(spark, two_days):
    base, items = two_days, default_catalog(spark)
    silver = lake.read_table(spark, base)
    picks, offers = (stage(rows(silver), "rows") for rows in (gold_items.selections, gold_items.exposures))
    whole = gold_tables(silver, picks, offers, items, lambda name, rows: stage(rows, name))
    whole = {t: sorted(map(str, rows.select(*gold_columns(t)).collect())) for t, rows in whole.items() if t != "run_summary"}
    gold_states.refresh_dates(silver.where("run_id NOT LIKE '%11'"), base, DAYS)
    first = f"{base}/silver/received_date={DAYS[0]}"
    for name in os.listdir(first):  # whoever reads the other date now fails
        if name.endswith(".parquet"):
            os.chmod(f"{first}/{name}", 0o644)
            open(f"{first}/{name}", "wb").write(b"no parquet")
        elif name.endswith(".crc"):
            os.remove(f"{first}/{name}")
    gold_states.refresh_dates(lake.read_table(spark, base), base, DAYS[1:])
    found = gold_states.gold_from_states(spark, base, items)
    assert {t: sorted(map(str, rows.select(*gold_columns(t)).collect())) for t, rows in found.items()} == whole


def test_the_gate_counts_what_is_written(spark, two_days):
    silver, items = lake.read_table(spark, two_days), default_catalog(spark)
    picks, offers = (stage(rows(silver), "rows") for rows in (gold_items.selections, gold_items.exposures))
    gate = ObservedGate()
    with pytest.raises(QualityGateError, match="not written yet"):
        gate.require()
    tables = gold_tables(silver, picks, offers, items, gate.put)
    gate.put_picks(picks, items.where("item_id <> 'bone'"))
    assert set(tables) == set(GOLD) and tables["run_summary"].count() == 4
    assert {check: n for check, n in gate.results().items() if n} == {"item_catalog_coverage": 1}
    with pytest.raises(QualityGateError, match="item_catalog_coverage"):
        gate.require()
    gate.put_picks(picks, items)
    gate.require()
    gate.put("upgrade_funnel", tables["upgrade_funnel"].withColumn("exposure_count", F.lit(0)))
    assert gate.results()["upgrade_funnel_ranges"] == tables["upgrade_funnel"].count() > 0
    gate.put("upgrade_funnel", tables["upgrade_funnel"].limit(0))  # an empty table has no failing row
    gate.require()


def test_ingest_packs_small_pieces(spark, full_run, tmp_path):
    rows = [(json.dumps(e), False, "turkiye_gateway") for e in full_run] * 20
    requests = spark.createDataFrame(rows, ingest.REQUESTS).repartition(16)
    ingest.store_batch(requests, 0, str(tmp_path / "bronze"), str(tmp_path / "rejects"))
    files = [f for _, _, names in os.walk(tmp_path / "bronze") for f in names if f.startswith("part-")]
    assert len(files) == 1 and spark.read.text(str(tmp_path / "bronze")).count() == 100


def test_dates_prune_the_external_table(spark, two_days, tmp_path):
    table = lake.external_table(spark, two_days)
    assert table.count() == 20
    days = spark.createDataFrame([(d, k) for k, d in enumerate(DAYS)], "d string, k int").select(F.to_date("d").alias("day"), "k")
    days.write.parquet(str(tmp_path / "days"))
    joined = table.join(spark.read.parquet(str(tmp_path / "days")).where("k = 1"), F.col("received_date") == F.col("day"))
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 10
    # A date that is stored later is found as well.
    table.where(f"received_date = DATE '{DAYS[0]}'").withColumn("received_date", F.to_date(F.lit("2026-03-05"))).write.partitionBy(
        "received_date").mode("append").parquet(f"{two_days}/silver")
    assert lake.external_table(spark, two_days).count() == 30
