"""Gold on small hand-made Silver rows, against plain Python."""

from __future__ import annotations

import json
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from runtrace.functions.numeric import cents, ratio
from runtrace.operators import gold_items, gold_progression, gold_runs, gold_weapons
from runtrace.operators.quality import QualityGateError, require_quality
from runtrace.sources.catalog import default_catalog, duplicate_items

COLUMNS = (
    "run_id string, event_id string, event_name string, event_sequence bigint, run_elapsed_seconds double, "
    "source_type string, game_version string, schema_version string, run_status string, first_received_at timestamp, "
    "ingestion_channel string, event_payload_json string, quality_issues_json string, input_event_count bigint, "
    "unique_event_count bigint, exact_retry_count bigint, conflicting_duplicate_count bigint, received_date date"
)


def silver_frame(spark, events):
    """(run, sequence, name, elapsed, payload[, version[, source]]) as Silver rows."""
    import datetime as dt

    rows = []
    for run, seq, name, elapsed, payload, *rest in events:
        version, source = (list(rest) + ["0.1.0", "CONSENTED_PROD_PLAY"][len(rest):])[:2]
        rows.append((run, f"{run}-{seq}-{len(rows)}", name, seq, float(elapsed), source, version, "2.0", "valid",
                     dt.datetime(2026, 3, 1, 10), "turkiye_gateway", json.dumps(payload), "[]", 5, 5, 0, 0,
                     dt.date(2026, 3, 1)))
    return spark.createDataFrame(rows, COLUMNS)


def shown(run, seq, choice, source, *options, elapsed=0):
    return (run, seq, "upgrade_options_shown", elapsed, {
        "choice_id": choice, "choice_source": source,
        "options": [{"slot": i, "item_id": item, "rarity": rarity} for i, (item, rarity) in enumerate(options, 1)]})


def picked(run, seq, choice, source, item, rarity="common", elapsed=0):
    return (run, seq, "upgrade_selected", elapsed, {
        "choice_id": choice, "choice_source": source, "selected_item_id": item, "selected_rarity": rarity})


def ended(run, seq, elapsed, reason="player_death", kills=10, level=3):
    return (run, seq, "run_ended", elapsed, {
        "end_reason": reason, "final_level": level, "total_kills": kills, "current_gold": 1})


def test_cents_round_half_away_from_zero(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(-10**6, 10**6), rng.randint(1, 400)) for _ in range(300)] + [(1, 200), (-1, 200), (5, 0)]
    rows = spark.createDataFrame(pairs, "a bigint, b bigint").select(
        "a", "b", cents(F.col("a"), F.col("b")).alias("c"), ratio(F.col("a"), F.col("b")).alias("r")).collect()
    for row in rows:
        if row["b"] == 0:
            assert row["c"] is None and row["r"] is None
        else:
            exact = Decimal(row["a"]) / Decimal(row["b"])
            assert row["c"] == exact.quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_funnel_multiplies_repeated_items(spark):
    """A level-up choice that lists one item in two rarities counts one pick for both."""
    rows = silver_frame(spark, [
        shown("a", 1, "c1", "level_up_upgrade", ("x", "common"), ("x", "rare")),
        picked("a", 2, "c1", "level_up_upgrade", "x", "rare"),
        shown("b", 1, "c2", "level_up_upgrade", ("x", "common"), ("y", "common")),
        shown("c", 1, "c3", "level_up_upgrade", ("x", "common"), ("y", "common")),
        picked("c", 2, "c3", "level_up_upgrade", "y"), picked("c", 3, "c3", "level_up_upgrade", "y"),
    ])
    found = {(r["item_id"], r["rarity"]): (r["exposure_count"], r["selection_count"], float(r["selection_percentage"]))
             for r in gold_items.upgrade_funnel(gold_items.exposures(rows), gold_items.selections(rows)).collect()}
    assert found == {("x", "common"): (3, 1, 33.33), ("x", "rare"): (1, 1, 100.0), ("y", "common"): (3, 2, 66.67)}


def test_progression_against_brute_force(spark):
    rng = random.Random(8)
    events, reached = [], defaultdict(list)
    for i in range(60):
        version, top = rng.choice("ab"), rng.choice([0, 0, 1, 3, 3, 7, 12])
        events.append((f"r{i}", 1, "run_started", 0, {}, version))
        if top:
            events.append((f"r{i}", 2, "run_checkpoint", 60 * top, {"checkpoint_number": top}, version))
        reached[version].append(top)
    events.append(("none", 1, "run_started", 0, {}, "c"))
    events.append(("high", 1, "run_started", 0, {}, "d"))
    events.append(("high", 2, "run_checkpoint", 60, {"checkpoint_number": 20_001}, "d"))
    result = gold_progression.run_progression(gold_runs.product_run_summary(silver_frame(spark, events)))
    rows = {(r["game_version"], r["checkpoint_number"]): r for r in result.collect()}
    for version, tops in reached.items():
        before = len(tops)
        for n in range(1, max(tops) + 1):
            row, now = rows[version, n], sum(t >= n for t in tops)
            assert (row["started_run_count"], row["reached_run_count"]) == (len(tops), now)
            assert row["previous_reached_run_count"] == before
            before = now
    assert not any(version == "c" for version, _ in rows)
    assert sum(version == "d" for version, _ in rows) == 20_001


def test_first_pick_outcome_and_sample_status(spark):
    events = []
    for i in range(31):
        run = f"r{i}"
        events += [picked(run, 2, "c", "statue", "sword", "rare", elapsed=70),
                   picked(run, 4, "d", "statue", "sword", "epic", elapsed=100),
                   ended(run, 9, 120 if i < 30 else 200, kills=i)]
    rows = silver_frame(spark, events)
    found = gold_items.upgrade_post_selection(gold_items.selections(rows), gold_runs.product_run_summary(rows)).collect()
    assert len(found) == 1
    row = found[0]
    assert (row["rarity"], row["selection_minute"], row["selection_count"], row["selected_run_count"]) == (
        "rare", 1, 62, 31)
    assert row["death_within_60_seconds_count"] == 30 and row["analysis_status"] == "DESCRIPTIVE_ONLY"
    assert row["average_seconds_after_selection"] == Decimal("52.58") and row["average_total_kills"] == Decimal("15.00")


def test_empty_arms_give_null_not_zero(spark):
    rows = silver_frame(spark, [
        shown("a", 1, "c", "statue", ("sword", "rare"), ("hourglass", "rare")), picked("a", 2, "c", "statue", "sword"),
        ended("a", 3, 90),
    ])
    found = {r["item_id"]: r for r in gold_items.option_outcome_comparison(
        gold_items.exposures(rows), gold_items.selections(rows), gold_runs.product_run_summary(rows), default_catalog(spark)).collect()}
    assert found["sword"]["not_selected_average_kills"] is None and found["sword"]["average_kill_difference"] is None
    assert found["hourglass"]["selected_run_count"] == 0 and found["sword"]["display_name"] == "Sword"


def test_weapon_popularity_keeps_unmet_weapons(spark):
    rows = silver_frame(spark, [
        ("a", 3, "run_started", 0, {"starting_weapon_id": "bone"}),
        shown("a", 1, "c", "level_up_weapon", ("bone", "common"), ("steak", "common")),
        picked("a", 2, "c", "level_up_weapon", "bone"),
        shown("a", 4, "d", "statue", ("bone", "common")), picked("a", 5, "d", "statue", "bone"),
    ])
    found = {r["weapon_id"]: r for r in gold_weapons.weapon_popularity(
        gold_items.exposures(rows), gold_items.selections(rows), gold_runs.product_run_summary(rows), default_catalog(spark)).collect()}
    assert len(found) == 4
    bone, fireball = found["bone"], found["fireball"]
    assert (bone["starting_run_count"], bone["exposure_count"], bone["selection_count"],
            bone["first_selected_run_count"]) == (1, 1, 1, 1)
    assert (fireball["exposure_count"], fireball["selection_percentage"]) == (0, None)


def test_catalog_has_24_unique_items(spark):
    catalog = default_catalog(spark)
    assert catalog.count() == 24 and duplicate_items(catalog).count() == 0
    assert duplicate_items(catalog.union(catalog)).count() == 24


def test_gate_stops_on_failure(spark):
    passed = spark.createDataFrame([("a", 0, "PASS")], "check_name string, failed_row_count int, check_status string")
    require_quality(passed)
    with pytest.raises(QualityGateError, match="b"):
        require_quality(passed.union(spark.createDataFrame([("b", 2, "FAIL")], passed.schema)))
