"""The mix against a replay of its schedule in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from runtrace.llm import mixing as op
from runtrace.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes, cap=3):
    """Exact targets: shares by weight, what is above the cap shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        target = {s: Fraction(cap * sizes[s]) if s in full else Fraction(rest * weight[s], total) for s in names}
        over = {s for s in names if target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def _stream(rows, source, size):
    own = [r for r in rows if r[2] == source]
    key = lambda r: (hashlib.md5(("mix:" + ("" if r[0] is None else str(r[0]))).encode()).hexdigest(), r[0] is not None, r[0] or 0, size(r))
    return sorted(own, key=key)


def _size(row):
    return len(WORD.findall(row[1] or ""))


def _rows():
    dice = random.Random(21)
    rows = [(i, " ".join(["wörd"] * dice.choice([0, 1, 3, 40, 200])) + dice.choice(["", "\n", " x"]),
             dice.choice(["hot"] * 6 + ["b", "é", None, "Z"])) for i in range(150)]
    return rows + [(500, "one two", "tiny"), (501, None, "none"), (502, " \t", "none"), (None, "a b c", "b"), (None, None, None), rows[0], rows[0],
                   (0, "other", rows[0][2]), (600, "w " * 9000, "long"), (601, "z", "é")]


def _frame(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return frame.withColumns({c: F.lit(c) for c in ("size", "row", "slot", "place", "rank", "target", "taken", "group_no", "weight", "n", "first")})


@pytest.mark.parametrize("block_words,least_slots", [(op.BLOCK_WORDS, op.LEAST_SLOTS), (100, 8), (1, 4)])
def test_a_mix(spark, block_words, least_slots):
    rows = _rows()
    mixed = op.mix(_frame(spark, rows), block_words=block_words, least_slots=least_slots)
    sizes = {}
    for row in rows:
        sizes[row[2]] = sizes.get(row[2], 0) + _size(row)
    target = _targets(sizes)
    got = op.taken(mixed).collect()
    assert len(got) == len(rows)
    taken = {s: 0 for s in sizes}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - float(target[r.source])) < 1e-6
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(target[s]) for s in sizes)
    spans = mixed.spans.orderBy("slot", "at").collect()
    by_source: dict = {}
    for s in spans:
        by_source.setdefault(s.source, {}).setdefault(s.slot, 0)
        by_source[s.source][s.slot] += s.end - s.begin
    slots = [n for own in by_source.values() for n in own]
    assert len(slots) == len(set(slots)) and max(slots) < mixed.n_slots  # a slot belongs to one source
    for source, own in by_source.items():
        if len(own) > 1:
            assert max(own.values()) - min(own.values()) <= 1  # equal blocks
    # any stretch of the schedule is near its shares
    per_slot = sum(taken.values()) / mixed.n_slots
    if block_words == 100:
        for source in ("hot", "long"):
            for end in range(1, mixed.n_slots + 1):
                share = sum(n for slot, n in by_source[source].items() if slot < end)
                assert abs(share - taken[source] * end / mixed.n_slots) < 4 * per_slot
    # words of a source come in the order of its shuffled stream, pass after pass
    for source in ("hot", "tiny", None):
        stream = [(r[0], i) for r in _stream(rows, source, _size) for i in range(_size(r))]
        said = [(s.doc_id, i) for s in spans if s.source == source for i in range(s.begin, s.end)]
        assert said == [stream[i % len(stream)] for i in range(taken[source])]


def test_reruns_agree_and_other_seeds_shuffle_otherwise(spark):
    frame = _frame(spark, _rows())
    key = lambda **more: sorted(map(str, op.mix(frame, block_words=50, **more).spans.collect()))
    first = key()
    assert first == sorted(map(str, op.mix(frame.repartition(7), block_words=50).spans.collect()))
    assert first != key(seed="another")


def test_empty_tables(spark, tmp_path):
    frame = _frame(spark, _rows())
    for some in (frame.limit(0), frame.where("source = 'none'")):
        mixed = op.mix(some)
        assert mixed.spans.count() == 0 and {r.taken for r in op.taken(mixed).collect()} <= {0}
    frame.select("doc_id", "text", "source").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_mixing(spark, str(tmp_path))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and got.count() == len(_rows())
