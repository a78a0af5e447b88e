"""Run reconstruction: sequence rules, retries, conflicts, lateness, owner dates, and skew-safe scanning."""

from __future__ import annotations

import copy
import json
import random

import pytest
from conftest import bronze_lines, deliveries, rename
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.operators import sequence
from runtrace.operators.ordered_scan import levels_for, look_back
from runtrace.operators.reconstruct import (
    issue_lists,
    reconstruct,
    reconstruct_date,
    silver_rows,
    strict_date,
)
from runtrace.sources.bronze import open_envelopes, sound_deliveries


def judge_all(spark, cases):
    """`judge` for many runs at once: {name: events} -> {name: (status, issues, row)}."""
    numbers = {name: f"{i:03d}" for i, name in enumerate(cases, 1)}
    events = [e for name, run in cases.items() for e in rename(run, numbers[name], f"2{numbers[name]}0000")]
    result = reconstruct(deliveries(spark, events, times=["2026-03-01T10:00:00Z"] * len(events)))
    names = {f"30000000-0000-4000-8000-{number:0>12}": name for name, number in numbers.items()}
    found = {name: [] for name in cases}
    for r in result.issues.collect():
        found[names[r["run_id"]]] += [(r["code"], "/".join(r["path"]))] * r["copies"]
    return {
        names[r["run_id"]]: (r["run_status"], sorted(found[names[r["run_id"]]]), r) for r in result.runs.collect()
    }


def test_retries_gaps_and_conflicts(spark, full_run):
    shuffled = [full_run[i] for i in (4, 2, 0, 3, 1)]
    other = {**full_run[3], "total_kills": 16}
    found = judge_all(spark, {
        "retry": [*shuffled, full_run[3]],
        "gap": full_run[:3] + full_run[4:],
        "no end": full_run[:4],
        "no start": full_run[3:],
        "conflict": [*full_run, other, other],
        "key order": [*full_run, dict(reversed(full_run[3].items()))],
        "number type": [*full_run, {**full_run[3], "run_elapsed_seconds": 60.0}],
    })
    status, issues, row = found["retry"]
    assert (status, issues) == ("valid", [])
    assert (row["input_event_count"], row["unique_event_count"], row["exact_retry_count"]) == (6, 5, 1)
    assert row["conflicting_duplicate_count"] == 0 and row["quality_issue_count"] == 0
    assert found["gap"][:2] == ("incomplete", [(contract.EVENT_SEQUENCE_GAP, "event_sequence")])
    assert found["no end"][:2] == ("incomplete", [(contract.MISSING_RUN_END, "")])
    assert found["no start"][0] == "incomplete"
    status, issues, row = found["conflict"]
    assert status == "invalid" and set(issues) == {(contract.DUPLICATE_CONFLICT, "event_id")} and len(issues) <= 2
    assert row["unique_event_count"] == 5 and row["quality_issue_count"] == row["conflicting_duplicate_count"]
    assert found["key order"][2]["exact_retry_count"] == 1
    assert found["number type"][2]["conflicting_duplicate_count"] == 1


def test_first_received_body_stays(spark, full_run):
    other = {**full_run[3], "total_kills": 16}
    result = reconstruct(deliveries(spark, [*full_run, other, other]))
    kept = result.events.where("event_sequence = 4").first()
    assert '"total_kills":15' in kept["event_json"] and kept["conflicts"] == 2
    assert result.runs.first()["quality_issue_count"] == 2


def change(events, index, **members):
    changed = copy.deepcopy(events)
    changed[index].update(members)
    return changed


def extra(events, index, number, **members):
    event = copy.deepcopy(events[index])
    event.update(event_id=f"10000000-0000-4000-8000-0000000009{number:02d}")
    event.update(members)
    return event


def test_sequence_rules(spark, full_run):
    late = extra(full_run, 3, 1, event_sequence=6, checkpoint_number=2, run_elapsed_seconds=120)
    cases = {
        "same number twice": ([*full_run, extra(full_run, 3, 2)], (contract.EVENT_SEQUENCE_CONFLICT, "event_sequence")),
        "elapsed falls": (change(full_run, 4, run_elapsed_seconds=30),
                          (contract.COUNTER_DECREASED, "run_elapsed_seconds")),
        "kills fall": (change(full_run, 4, total_kills=3), (contract.COUNTER_DECREASED, "total_kills")),
        "after the end": ([*full_run, late], (contract.EVENT_ORDER_INVALID, "event_sequence")),
        "selected first": (change(change(full_run, 0, event_sequence=2), 1, event_sequence=1),
                           (contract.EVENT_ORDER_INVALID, "event_sequence")),
        "other version": (change(full_run, 3, game_version="0.2.0"), (contract.CORRELATION_MISMATCH, "game_version")),
        "other item": (change(full_run, 1, selected_item_id="steak"), (contract.CHOICE_MISMATCH, "choice_id")),
        "checkpoint off the minute": (change(full_run, 3, run_elapsed_seconds=61),
                                      (contract.EVENT_ORDER_INVALID, "run_elapsed_seconds")),
        "early checkpoint": (change(change(full_run, 3, event_sequence=3), 2, event_sequence=4),
                             (contract.EVENT_ORDER_INVALID, "event_sequence")),
        "second start": ([*full_run[:4], extra(full_run, 2, 3, event_sequence=5),
                          {**full_run[4], "event_sequence": 6}], (contract.EVENT_ORDER_INVALID, "event_name")),
        "choice number repeats": ([*full_run[:4], extra(full_run, 0, 4, event_sequence=5, run_elapsed_seconds=70,
                                   choice_id="40000000-0000-4000-8000-0000000000bb"),
                                   {**full_run[4], "event_sequence": 6}],
                                  (contract.COUNTER_DECREASED, "choice_sequence")),
    }
    found = judge_all(spark, {name: events for name, (events, _) in cases.items()})
    for name, (_, expected) in cases.items():
        status, issues, _ = found[name]
        assert status == "invalid", name
        assert expected in issues, (name, issues)


def test_single_causes(spark, full_run):
    """Counters 10, -, 5, 7: only 5 is a fall, 7 is measured against 5. An event issue hides the rest."""
    checkpoints = [
        extra(full_run, 3, 10 + i, event_sequence=4 + i, checkpoint_number=1 + i, run_elapsed_seconds=60 * (1 + i),
              **({} if hearts is None else {"hearts_collected": hearts}))
        for i, hearts in enumerate([10, None, 5, 7])
    ]
    end = {**full_run[4], "event_sequence": 8, "run_elapsed_seconds": 300}
    found = judge_all(spark, {
        "fall": [*full_run[:3], *checkpoints, end],
        "orphan": change(full_run, 1, choice_id="40000000-0000-4000-8000-0000000000ff"),
        "event": change(full_run[:4], 3, hp_percent=400),
    })
    assert found["fall"][:2] == ("invalid", [(contract.COUNTER_DECREASED, "hearts_collected")])
    assert found["orphan"][:2] == ("incomplete", [(contract.CHOICE_NOT_FOUND, "choice_id")])
    assert found["event"][:2] == ("invalid", [(contract.SCHEMA_INVALID, "hp_percent")])


def test_shared_event_id_breaks_both_runs(spark, full_run):
    other = rename(full_run, "bb", "20000000")
    other[3]["event_id"] = full_run[3]["event_id"]
    result = reconstruct(deliveries(spark, full_run + other))
    assert [r["run_status"] for r in result.runs.collect()] == ["invalid", "invalid"]
    assert {r["code"] for r in result.issues.collect()} == {contract.DUPLICATE_CONFLICT}


def test_owner_date_lateness_and_other_dates(spark, full_run):
    night = ["2026-03-01T23:5{}:00.000Z".format(i) for i in (7, 8)] + [
        "2026-03-02T00:0{}:00Z".format(i) for i in (1, 2)] + ["2026-03-02T09:03:00+09:00"]
    rows = deliveries(spark, full_run, times=night)
    owned = reconstruct_date(rows, "2026-03-01").runs.collect()
    assert [(r["run_status"], r["unique_event_count"]) for r in owned] == [("valid", 5)]
    assert reconstruct_date(rows, "2026-03-02").runs.count() == 0
    exact = [*night[:4], "2026-03-02T23:57:00.000Z"]
    assert reconstruct(deliveries(spark, full_run, times=exact)).runs.first()["run_status"] == "valid"
    late = [*night[:4], "2026-03-02T23:57:00.001Z"]
    result = reconstruct(deliveries(spark, full_run, times=late))
    assert result.runs.first()["run_status"] == "invalid"
    assert [r["code"] for r in result.issues.collect()] == [contract.EVENT_ARRIVAL_TOO_LATE]
    longer = reconstruct(deliveries(spark, full_run, times=late), allowed_lateness="2 days")
    assert longer.runs.first()["run_status"] == "valid"
    for wrong in ("0 hours", "-1 hours", "1 hour or so"):
        with pytest.raises(ValueError):
            reconstruct(rows, allowed_lateness=wrong)


@pytest.mark.parametrize("text", ["2026-9-3", "20260903", "2026-02-30", "2026-09-03 ", "x"])
def test_dates_are_strict(text):
    with pytest.raises(ValueError):
        strict_date(text)


def test_broken_envelopes(spark, full_run):
    good = json.loads(bronze_lines(spark, full_run[:1]).first()["value"])
    bad = [
        {**good, "bronze_record_version": 2}, {**good, "event": 5}, {k: v for k, v in good.items() if k != "metadata"},
        {**good, "metadata": {"received_at": "2026-03-01T10:00:00", "ingestion_channel": "x"}},
        {**good, "metadata": {"received_at": 5, "ingestion_channel": "x"}},
        {**good, "event": {**good["event"], "run_id": 5}},
    ]
    lines = spark.createDataFrame([(json.dumps(r),) for r in [good, *bad]] + [("{not json",)], "value string")
    opened = open_envelopes(lines)
    assert opened.where("envelope_error IS NULL").count() == 1
    assert sound_deliveries(opened).count() == 1
    with pytest.raises(Exception, match="broken bronze record"):
        sound_deliveries(opened, strict=True).select("run_id").collect()


def test_input_order_and_retries_never_change_silver(spark, full_run):
    events = full_run + rename(full_run[:4], "cc", "20000000") + rename(full_run[1:], "dd", "60000000")
    times = [f"2026-03-01T10:{i // 60:02d}:{i % 60:02d}.000Z" for i in range(len(events))]
    lines = bronze_lines(spark, events, times=times)
    columns = [c for c in silver_rows(reconstruct(sound_deliveries(open_envelopes(lines)))).columns
               if c not in ("input_event_count", "exact_retry_count")]

    def rows(frame):
        return sorted(silver_rows(reconstruct(sound_deliveries(open_envelopes(frame)))).select(*columns).collect())

    repeated = [(line["value"],) for line in lines.collect()] * 2
    random.Random(5).shuffle(repeated)
    assert rows(lines) == rows(spark.createDataFrame(repeated, "value string"))


def test_issue_lists_are_counted_by_code(spark, full_run):
    gaps = [extra(full_run, 3, i, event_sequence=10 * i, checkpoint_number=i, run_elapsed_seconds=60 * i)
            for i in range(1, 9)]
    result = reconstruct(deliveries(spark, [full_run[2] | {"event_sequence": 1}, *gaps]))
    listed = json.loads(issue_lists(result.issues).first()["quality_issues_json"])
    assert listed == [{"code": "event_sequence_gap", "count": 8}, {"code": "missing_run_end", "count": 1}]
    assert result.runs.first()["quality_issue_count"] == 9 and result.issues.count() == 9


def test_silver_rows_hold_every_issue_of_their_run(spark, full_run):
    """One entry for each issue, those of repeated deliveries too, with all its members, in the order of the rules."""
    first, second = full_run[:4], rename(full_run[:1] + full_run[2:], "bb", "20000000")
    other = {**first[3], "total_kills": 16}
    result = reconstruct(deliveries(spark, [*first, other, other, *second], times=[f"2026-03-01T10:00:{i:02d}Z" for i in range(10)]))
    rows = silver_rows(result).collect()
    lists = {r["run_id"][-2:]: json.loads(r["quality_issues_json"]) for r in rows}
    assert {r["run_id"][-2:]: r["quality_issue_count"] for r in rows} == {"aa": 3, "bb": 1}
    conflict = {"code": "duplicate_conflict", "event_id": first[3]["event_id"], "path": ["event_id"],
                "message": "the same event_id was delivered with different content"}
    no_end = {"code": "missing_run_end", "event_id": None, "path": [], "message": "the sequence contains no run_ended event"}
    gap = {"code": "event_sequence_gap", "event_id": second[1]["event_id"], "path": ["event_sequence"],
           "message": "missing event_sequence values between 1 and 3"}
    assert lists == {"aa": [conflict, conflict, no_end], "bb": [gap]}
    assert list(lists["aa"][0]) == ["code", "event_id", "message", "path"]
    assert len({(r["run_id"], r["quality_issues_json"]) for r in rows}) == 2 and len(rows) == 8


def test_sliced_scan_equals_plain_window(spark):
    """One run holds half of all events; with 3-bit slices no window sees more than 8 rows."""
    rng = random.Random(11)
    rows = [("hot", seq) for seq in rng.sample(range(1, 5000), 300)]
    rows += [(f"r{i}", seq) for i in range(40) for seq in rng.sample(range(1, 60), 8)]
    rows = [(run, seq, rng.choice([None, rng.randint(0, 50)]), rng.randint(0, 9)) for run, seq in rows]
    df = spark.createDataFrame(rows, "run_id string, seq bigint, a int, b int")
    plain = look_back(df, "seq", ["a", "b"], ["a"], 1)
    sliced = look_back(df, "seq", ["a", "b"], ["a"], levels_for(5000, 3), 3)
    assert levels_for(5000, 3) == 5 and sliced.columns == plain.columns
    assert sorted(map(str, sliced.collect())) == sorted(map(str, plain.collect()))
    assert levels_for(2**21 - 1) == 1 and levels_for(2**21) == 2 and levels_for(2**63 - 1) == 3


def test_rules_agree_between_slice_widths(spark, full_run):
    events = full_run + rename(change(full_run, 4, total_kills=3, run_elapsed_seconds=20), "ee", "20000000")
    one = reconstruct(deliveries(spark, events))
    two = reconstruct(deliveries(spark, events), bits=1)
    columns = sequence.ISSUE_COLUMNS
    assert sorted(map(str, one.issues.select(*columns).collect())) == sorted(map(str, two.issues.select(*columns).collect()))
    assert one.issues.where(F.col("code") == contract.COUNTER_DECREASED).count() == 2
