"""The rules a run's events must keep together. Every function returns issue rows.

Issue rows are (run_id, rule, code, message, path, event_id, copies, place, event_sequence): `rule` names the
check, `copies` counts equal issues, and (place, event_sequence) gives their order in a run's list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrace import contract
from runtrace.functions.payload import OPTIONS_TYPE, each, with_members
from runtrace.operators.ordered_scan import SLICE_BITS, levels_for, look_back
from runtrace.sources.staging import stage

_COUNTERS = [name for name in contract.MONOTONIC_COUNTERS if name != "run_elapsed_seconds"]

ISSUE_COLUMNS = ["run_id", "rule", "code", "message", "path", "event_id", "copies", "place", "event_sequence"]


_MEMBERS = dict(
    event_name="string",
    event_sequence="bigint",
    run_elapsed_seconds="double",
    source_type="string",
    game_version="string",
    schema_version="string",
    choice_id="string",
    choice_sequence="bigint",
    choice_source="string",
    options=OPTIONS_TYPE,
    selected_slot="bigint",
    selected_item_id="string",
    selected_rarity="string",
    checkpoint_number="bigint",
    **{name: "double" for name in _COUNTERS},
)


def typed_events(unique_events: DataFrame) -> DataFrame:
    """The members the rules look at, from the canonical text of deduplicated events; those that are columns already stay as they are."""
    columns = ["run_id", "event_id", "event_json", "first_received_at"]
    held = [name for name in _MEMBERS if name in unique_events.columns]
    parsed = unique_events.select(*columns, *held, F.try_parse_json("event_json").alias("event"))
    kinds = {name: kind for name, kind in _MEMBERS.items() if name not in held}
    return with_members(parsed, "event", **kinds).select(*columns, *_MEMBERS)


def ordered_events(unique_events: DataFrame) -> DataFrame:
    """The members of one event per run and sequence number: the earliest received. `claims` counts the events that wanted it.

    Numbers are counted first, from their column. An event that alone wants its number goes on as it is, without a shuffle or a sort of
    its text. Where several want it, a minimum over a struct narrows them down before the shuffle, however many they are.
    """
    numbered = unique_events.where("event_sequence IS NOT NULL")
    wanted = numbered.groupBy("run_id", "event_sequence").agg(F.count("*").alias("claims")).where("claims > 1")
    contested = stage(wanted.select(F.col("run_id").alias("run"), F.col("event_sequence").alias("number")), "contested")
    same = F.col("run_id").eqNullSafe(F.col("run")) & (F.col("event_sequence") == F.col("number"))
    alone = typed_events(numbered.join(contested, same, "left_anti")).withColumn("claims", F.lit(1).cast("bigint"))
    claimants = typed_events(numbered.join(contested, same, "left_semi"))
    kept = ["first_received_at", "event_json", *[c for c in claimants.columns if c not in (
        "run_id", "event_sequence", "first_received_at", "event_json")]]
    first = (
        claimants.groupBy("run_id", "event_sequence")
        .agg(F.min(F.struct(*kept)).alias("kept"), F.count("*").alias("claims"))
        .select("run_id", "event_sequence", "kept.*", "claims")
    )
    return alone.unionByName(first)


def _row(rule: str, code: str, message: Column | str, path: list[str], place: int, event_id: Column | None = None):
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(code).alias("code"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
        (F.array(*[F.lit(p) for p in path]) if path else F.array().cast("array<string>")).alias("path"),
        (F.col("event_id") if event_id is None else event_id).alias("event_id"),
        F.lit(1).cast("bigint").alias("copies"),
        F.lit(place).alias("place"),
        F.col("event_sequence"),
    )


def _found(rows: DataFrame, rules: list[tuple[Column, Column]]) -> DataFrame:
    """Issue rows of the rules that a row breaks. Most rows break none and are left out before any list is made."""
    any_broken = reduce(lambda a, b: a | b, [F.coalesce(broken, F.lit(False)) for broken, _ in rules])
    found = F.array_compact(F.array(*[F.when(broken, issue) for broken, issue in rules]))
    return each(rows.where(any_broken), ["run_id"], found, "i").select("run_id", "i.*").select(*ISSUE_COLUMNS)


def sequence_conflicts(events: DataFrame, ordered: DataFrame) -> DataFrame:
    """Events whose sequence number an earlier received event of the run already holds."""
    contested = ordered.where("claims > 1").select(
        "run_id", "event_sequence", F.col("event_id").alias("holder")
    )
    losers = events.select("run_id", "event_sequence", "event_id").join(contested, ["run_id", "event_sequence"])
    message = "different events use the same event_sequence"
    issue = _row("seq_conflict", contract.EVENT_SEQUENCE_CONFLICT, message, ["event_sequence"], 2)
    return _found(losers, [(F.col("event_id") != F.col("holder"), issue)])


def scanned(ordered: DataFrame, largest_sequence: int | None, bits: int = SLICE_BITS) -> DataFrame:
    """Ordered events with what each must be compared with: earlier values and facts about its run."""
    name = F.col("event_name")
    started, ended = name == "run_started", name == "run_ended"
    fields = ["game_version", "schema_version", "source_type"]
    facts = ordered.select(
        "*",
        F.when(name == "upgrade_options_shown", F.col("choice_sequence")).alias("shown_sequence"),
        F.when(name == "run_checkpoint", F.col("checkpoint_number")).alias("checkpoint"),
        F.when(started, F.col("event_sequence")).alias("start_at"),
        F.when(ended, F.col("event_sequence")).alias("end_at"),
        F.struct("event_sequence", *fields).alias("opening"),
        F.when(started, F.struct("event_sequence", *fields)).alias("start"),
    ).withColumn("sequence", F.col("event_sequence"))
    return look_back(
        facts,
        "event_sequence",
        ["sequence", "shown_sequence", "checkpoint", *contract.MONOTONIC_COUNTERS],
        ["start_at", "end_at", "opening", "start"],
        levels_for(largest_sequence, bits),
        bits,
    )


def order_issues(looked: DataFrame) -> DataFrame:
    """Gaps, boundaries, correlation, order and counters, in one pass over the scanned events."""
    name, seq = F.col("event_name"), F.col("event_sequence")
    shown, checkpoint = name == "upgrade_options_shown", name == "run_checkpoint"
    before = F.coalesce("prev_sequence", F.lit(0))
    first = seq == F.col("run_opening.event_sequence")
    nothing = F.lit(None).cast("string")
    reference = F.coalesce("run_start", "run_opening")
    order, counter = contract.EVENT_ORDER_INVALID, contract.COUNTER_DECREASED

    gap_message = F.concat(
        F.lit("missing event_sequence values between "), before.cast("string"), F.lit(" and "), seq.cast("string")
    )
    rules = [
        (seq > before + 1, _row("seq_gap", contract.EVENT_SEQUENCE_GAP, gap_message, ["event_sequence"], 3)),
        (first & F.col("run_start_at").isNull(),
         _row("run_boundary", contract.MISSING_RUN_START, "the sequence contains no run_started event", [], 4, nothing)),
        ((name == "run_started") & (seq > F.col("run_start_at")),
         _row("run_boundary", order, "the sequence contains more than one run_started event", ["event_name"], 4)),
        (first & F.col("run_end_at").isNull(),
         _row("run_boundary", contract.MISSING_RUN_END, "the sequence contains no run_ended event", [], 5, nothing)),
        ((name == "run_ended") & (seq > F.col("run_end_at")),
         _row("run_boundary", order, "the sequence contains more than one run_ended event", ["event_name"], 5)),
    ]
    rules += [
        (~F.col(member).eqNullSafe(reference[member]),
         _row("correlation", contract.CORRELATION_MISMATCH, f"{member} does not match the run", [member], 6))
        for member in ("game_version", "schema_version", "source_type")
    ]
    opening_choice = (
        name.isin("upgrade_options_shown", "upgrade_selected")
        & (F.col("choice_source") == "level_up_weapon")
        & (F.col("run_elapsed_seconds") == 0)
    )
    rules += [
        ((seq < F.col("run_start_at")) & ~F.coalesce(opening_choice, F.lit(False)),
         _row("before_start", order, "only a zero-time initial weapon choice may precede run_started",
              ["event_sequence"], 7)),
        (seq > F.col("run_end_at"),
         _row("after_end", order, "an event occurs after run_ended in run order", ["event_sequence"], 9)),
        (shown & (F.col("choice_sequence") <= F.coalesce("prev_shown_sequence", F.lit(0))),
         _row("choice_order", counter, "choice_sequence must strictly increase for shown choices",
              ["choice_sequence"], 9)),
        (shown & (F.array_sort(F.transform("options", lambda o: o["slot"])) != F.when(
            F.col("choice_source") == "statue", F.expr("array(1L, 2L, 3L)")).otherwise(F.expr("array(1L, 2L)"))),
         _row("option_slots", contract.CHOICE_MISMATCH, "options do not match the slots of the choice source",
              ["options"], 9)),
        (checkpoint & (F.col("checkpoint_number") <= F.coalesce("prev_checkpoint", F.lit(0))),
         _row("checkpoint_rules", counter, "checkpoint_number must strictly increase", ["checkpoint_number"], 9)),
        (checkpoint
         & (F.col("run_elapsed_seconds") != F.col("checkpoint_number") * F.lit(contract.CHECKPOINT_SECONDS)),
         _row("checkpoint_rules", order, "run_elapsed_seconds must equal checkpoint_number multiplied by 60",
              ["run_elapsed_seconds"], 9)),
    ]
    rules += [
        (F.col(member) < F.col(f"prev_{member}"),
         _row("counter_decreased", counter, f"{member} decreased within the run", [member], 9))
        for member in contract.MONOTONIC_COUNTERS
    ]
    return _found(looked, rules)


def choice_issues(ordered: DataFrame) -> DataFrame:
    """Shown choices that reuse a choice_id, and selections that do not fit the choice they name.

    The first shown event of each choice is a minimum per (run, choice); choice events then meet at most one row.
    """
    choices = ordered.where("event_name IN ('upgrade_options_shown', 'upgrade_selected')")
    first = (
        choices.where("event_name = 'upgrade_options_shown'")
        .groupBy("run_id", "choice_id")
        .agg(F.min(F.struct("event_sequence", "event_id", "choice_sequence", "choice_source", "options")).alias("shown"))
    )
    linked = choices.join(first, ["run_id", "choice_id"], "left")
    selected, found = F.col("event_name") == "upgrade_selected", F.col("shown").isNotNull()
    offered = F.transform("shown.options", lambda o: F.struct(o["slot"], o["item_id"], o["rarity"]))
    taken = F.struct(
        F.col("selected_slot").alias("slot"),
        F.col("selected_item_id").alias("item_id"),
        F.col("selected_rarity").alias("rarity"),
    )
    differs = (
        ~F.coalesce(F.array_contains(offered, taken), F.lit(False))
        | (F.col("choice_sequence") != F.col("shown.choice_sequence"))
        | (F.col("choice_source") != F.col("shown.choice_source"))
    )
    return _found(
        linked,
        [
            (~selected & (F.col("event_id") != F.col("shown.event_id")),
             _row("choice_reuse", contract.CHOICE_MISMATCH, "the same choice_id identifies different shown choices",
                  ["choice_id"], 8)),
            (selected & ~found,
             _row("choice_linkage", contract.CHOICE_NOT_FOUND, "no upgrade_options_shown uses this choice_id",
                  ["choice_id"], 9)),
            (selected & found & (F.col("shown.event_sequence") >= F.col("event_sequence")),
             _row("choice_linkage", contract.EVENT_ORDER_INVALID, "upgrade_selected must follow upgrade_options_shown",
                  ["event_sequence"], 9)),
            (selected & found & differs,
             _row("choice_linkage", contract.CHOICE_MISMATCH, "selected upgrade does not match the linked options",
                  ["choice_id"], 9)),
        ],
    )


def all_sequence_issues(
    events: DataFrame, ordered: DataFrame, largest_sequence: int | None, bits: int = SLICE_BITS
) -> DataFrame:
    parts = [
        sequence_conflicts(events, ordered),
        order_issues(scanned(ordered, largest_sequence, bits)),
        choice_issues(ordered),
    ]
    return reduce(DataFrame.unionByName, parts)
