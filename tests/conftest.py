from __future__ import annotations

import copy
import json
import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RUN = "30000000-0000-4000-8000-0000000000aa"
CHOICE = "40000000-0000-4000-8000-0000000000aa"


def _common(number: int, name: str, elapsed, **own) -> dict:
    return {
        "event_id": f"10000000-0000-4000-8000-{number:012d}",
        "event_name": name,
        "source_type": "CONSENTED_PROD_PLAY",
        "run_id": RUN,
        "event_sequence": number,
        "run_elapsed_seconds": elapsed,
        "game_version": "0.1.0",
        "schema_version": "2.0",
        **own,
    }


@pytest.fixture
def full_run() -> list[dict]:
    """Shown, selected, started, one checkpoint, ended."""
    choice = {"choice_id": CHOICE, "choice_sequence": 1, "choice_source": "level_up_weapon"}
    return copy.deepcopy(
        [
            _common(1, "upgrade_options_shown", 0, **choice, options=[
                {"slot": 1, "item_id": "steak", "rarity": "common"},
                {"slot": 2, "item_id": "bone", "rarity": "rare"},
            ]),
            _common(2, "upgrade_selected", 0, **choice, selected_slot=2, selected_item_id="bone",
                    selected_rarity="rare"),
            _common(3, "run_started", 0, starting_max_hp=120, starting_weapon_id="bone"),
            _common(4, "run_checkpoint", 60, checkpoint_number=1, player_level=3, current_xp=7.5,
                    xp_to_next_level=20, hp_percent=80, total_kills=15, current_gold=4),
            _common(5, "run_ended", 95.5, end_reason="player_death", final_level=4, total_kills=31, current_gold=9),
        ]
    )


def rename(events: list[dict], run: str, prefix: str) -> list[dict]:
    """The same run under another run_id, with its own event ids."""
    renamed = copy.deepcopy(events)
    for event in renamed:
        event["run_id"] = f"30000000-0000-4000-8000-{run:0>12}"
        event["event_id"] = prefix + event["event_id"][len(prefix):]
    return renamed


def bronze_lines(spark, events, received="2026-03-01T10:00:{:02d}.000Z", channel="turkiye_gateway", times=None):
    """Events as Bronze lines, a second apart, or at the given times."""
    lines = []
    for i, event in enumerate(events):
        moment = times[i] if times else received.format(i)
        lines.append((json.dumps({
            "bronze_record_version": 1,
            "event": event,
            "metadata": {"received_at": moment, "ingestion_channel": channel},
        }),))
    return spark.createDataFrame(lines, "value string")


def deliveries(spark, events, **kwargs):
    from runtrace.sources.bronze import open_envelopes, sound_deliveries

    return sound_deliveries(open_envelopes(bronze_lines(spark, events, **kwargs)))


def event_frame(spark, events):
    return spark.createDataFrame([(i, json.dumps(e)) for i, e in enumerate(events)], "i int, j string").select(
        "i", F.try_parse_json("j").alias("event")
    )
