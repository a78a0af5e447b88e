"""Single-event rules: what is accepted, what is refused, and in which order reasons are given."""

from __future__ import annotations

import copy

import pytest
from conftest import event_frame
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.operators.validation import plainly_sound, validate_events

def spellings(key: str) -> list[str]:
    """A denied name in letter forms and with separators that normalisation takes away."""
    half = len(key) // 2
    return [key.upper(), key.capitalize(), f"{key[:half]}_{key[half:]}", f"{key[:half]}-{key[half:]}".title(),
            f"{key[0]}.{key[1:]}", f"{chr(0xFF21)}{key}"]


NAMES = [spelt for i, key in enumerate(contract.PROHIBITED_KEYS) for spelt in spellings(key)[i % 3::3]] + ["ſessionid"]


def judged(spark, events):
    rows = validate_events(event_frame(spark, events)).select("i", "issues").collect()
    return [row["issues"] for row in sorted(rows, key=lambda row: row["i"])]


def codes(spark, events):
    return [sorted({issue["code"] for issue in issues}) for issues in judged(spark, events)]


def test_all_event_types_are_valid(spark, full_run):
    assert judged(spark, full_run) == [[]] * 5
    sound = event_frame(spark, full_run).select(plainly_sound(F.col("event")).alias("s")).collect()
    assert all(row["s"] for row in sound)


def test_forbidden_names_in_any_spelling(spark, full_run):
    events = [{**full_run[2], name: "x"} for name in NAMES]
    for name, issues in zip(NAMES, judged(spark, events), strict=True):
        assert [i["code"] for i in issues] == [contract.PROHIBITED_FIELD], name
        assert issues[0]["path"] == [name]
        assert issues[0]["event_id"] == full_run[2]["event_id"]


def test_forbidden_name_inside_an_array_has_its_path(spark, full_run):
    event = {**full_run[2], "extra": {"items": [{"ok": 1}, {"Device-Id": "d", "inner": [{"e_mail": 1, "EMAIL": 2}]}]}}
    found = judged(spark, [event])[0]
    assert sorted(i["path"] for i in found) == [
        ["extra", "items", "1", "Device-Id"],
        ["extra", "items", "1", "inner", "0", "EMAIL"],
        ["extra", "items", "1", "inner", "0", "e_mail"],
    ]


def test_values_and_long_texts_are_not_names(spark, full_run):
    event = {**full_run[2], "map_id": "session", "note": 'say "ip": ' * 5000 + "\\"}
    assert codes(spark, [event]) == [[contract.SCHEMA_INVALID]]


def test_privacy_comes_before_schema(spark, full_run):
    event = {**full_run[2], "ip": 1, "unreviewed": 2, "event_sequence": -1}
    assert codes(spark, [event]) == [[contract.PROHIBITED_FIELD]]


@pytest.mark.parametrize("cause", contract.DEATH_CAUSES)
def test_death_causes(spark, full_run, cause):
    assert judged(spark, [{**full_run[4], "death_cause": cause}]) == [[]]


def test_death_cause_only_with_death_and_only_known(spark, full_run):
    other = [{**full_run[4], "end_reason": r, "death_cause": "fall"} for r in contract.END_REASONS[1:]]
    wrong = [{**full_run[4], "death_cause": c} for c in ("lava", "", None, {"type": "fall"}, 1)]
    assert codes(spark, other + wrong) == [[contract.SCHEMA_INVALID]] * 10


def test_refused_members(spark, full_run):
    started, shown, selected, checkpoint, ended = full_run[2], full_run[0], full_run[1], full_run[3], full_run[4]

    def without(event, name):
        return {k: v for k, v in event.items() if k != name}

    def options(*changes, source="level_up_weapon"):
        event = copy.deepcopy(shown)
        event["choice_source"] = source
        event["options"] = list(changes)
        return event

    a, b = shown["options"]
    refused = [
        *[without(started, name) for name in contract.COMMON_FIELDS],
        {**started, "event_time": "2026-01-01"},
        {**started, "event_id": "not-a-uuid"},
        {**started, "event_sequence": 0},
        {**started, "event_sequence": "3"},
        {**started, "event_sequence": True},
        {**started, "event_sequence": 1.5},
        {**started, "run_elapsed_seconds": 1},
        {**started, "run_elapsed_seconds": False},
        {**started, "game_version": "-1"},
        {**started, "game_version": "1" * 33},
        {**started, "schema_version": "1.0"},
        {**started, "schema_version": 2.0},
        {**started, "source_type": "OTHER"},
        {**started, "starting_max_hp": 0},
        {**started, "starting_weapon_id": "Bone"},
        {**started, "map_id": ""},
        {**started, "event_name": "run_paused"},
        {**started, "event_name": None},
        *[without(checkpoint, n) for n in ("checkpoint_number", "player_level", "hp_percent", "total_kills")],
        {**checkpoint, "hp_percent": 100.5},
        {**checkpoint, "xp_to_next_level": 0},
        {**checkpoint, "total_kills": -1},
        {**checkpoint, "active_upgrades": [{"item_id": "a", "acquisition_count": 1}] * 65},
        {**checkpoint, "active_upgrades": [{"item_id": "a", "acquisition_count": 0}]},
        {**checkpoint, "active_upgrades": [{"item_id": "a", "acquisition_count": 1}, {"item_id": "b"}]},
        {**checkpoint, "active_upgrades": [{"item_id": "a", "acquisition_count": 1, "more": 1}]},
        {**ended, "final_upgrades": {"item_id": "a"}},
        options(a),
        options(a, a),
        options(a, b, {**b, "slot": 3}),
        options(a, {**b, "rarity": "mythic"}),
        options(a, without(b, "item_id")),
        options(a, {**b, "extra": 1}),
        options(a, b, source="statue"),
        options(a, b, {"slot": 3, "item_id": "bone", "rarity": "rare"}, source="statue"),
        {**selected, "selected_slot": 3},
        {**selected, "selected_slot": 4, "choice_source": "statue", "selected_item_id": "sword"},
        {**selected, "choice_source": "statue"},
        {**selected, "choice_id": "x"},
        ["not", "an", "object"],
        "text",
        7,
    ]
    found = codes(spark, refused)
    assert [i for i, c in enumerate(found) if c != [contract.SCHEMA_INVALID]] == []


def test_accepted_variants(spark, full_run):
    started, shown, selected, checkpoint, ended = full_run[2], full_run[0], full_run[1], full_run[3], full_run[4]
    statue = [{"slot": s, "item_id": i, "rarity": "epic"} for s, i in ((1, "sword"), (3, "horseshoe"), (2, "hourglass"))]
    accepted = [
        {**started, "event_sequence": 3.0},
        {**started, "starting_max_hp": 99.5, "map_id": "m_1"},
        {**started, "event_id": started["event_id"].upper()},
        {**shown, "choice_source": "statue", "options": statue},
        {**shown, "player_level": 0, "options": [
            {**shown["options"][0], "acquisition_count_before": 0, "effect_type": "speed", "effect_value_before": 1.5},
            {**shown["options"][1], "effect_value_before": True}]},
        {**selected, "selected_slot": 3, "choice_source": "statue", "selected_item_id": "sword",
         "effect_value_after": False, "acquisition_count_after": 1},
        {**checkpoint, "active_upgrades": [], "total_xp_collected": 1e3, "hearts_collected": 0},
        {**checkpoint, "active_upgrades": [{"item_id": "a", "acquisition_count": 1, "effect_value": 2}] * 64},
        {**ended, "final_upgrades": [{"item_id": "a", "acquisition_count": 2.0}]},
    ]
    assert judged(spark, accepted) == [[]] * len(accepted)


def test_statue_items_must_differ(spark, full_run):
    options = [{"slot": s, "item_id": i, "rarity": "epic"} for s, i in ((1, "sword"), (2, "sword"), (3, "hourglass"))]
    event = {**full_run[0], "choice_source": "statue", "options": options}
    assert codes(spark, [event, {**event, "unreviewed": 1}]) == [[contract.CHOICE_MISMATCH], [contract.SCHEMA_INVALID]]
