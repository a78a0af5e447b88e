"""Every registered query beside its check SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from check_sql import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from workload.registry import registry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_every_query_but_the_text_ones_has_check_sql():
    assert set(registry()) <= set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, tables, name):
    line = compare(spark, tables, SF_DIR, name, queries()[name], oracle_sql()[name])
    assert "ok," in line, line


def test_reports_hold_the_whole_funnel(spark, tables):
    rows = queries()["report_payload_sources"](spark, SF_DIR).where("section = 'upgrade_funnel'").select("name").collect()
    whole = queries()["upgrade_funnel"](spark, SF_DIR).collect()
    assert sorted(r["name"] for r in rows) == sorted(f"{r.choice_source}/{r.item_id}/{r.rarity}" for r in whole)
    assert len({r.choice_source for r in whole}) > 1
