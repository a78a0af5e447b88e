"""Runs against a scan of every period in plain Python."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from runtrace.llm import periods as op
from runtrace.llm import queries


def _runs(words):
    """Every maximal stretch of each period, smallest periods first; a stretch counts with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def _changed(doc_id, words):
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def _expected(doc_id, text):
    words = _changed(doc_id, (text or "").encode().split())
    runs = _runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    said = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def _texts():
    dice = random.Random(11)
    texts = [None, "", "  \n", "a", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 4 + "a", "b " * 6 + "a b " * 5 + "a a a a a a",
             "x y " * 6, "a\x0bb\x0c" * 9, "é ü " * 7, "A a " * 5, "a " * 4000, "a b a " * 900 + "c " * 700, "to be or not " * 4 + "to"]
    for letters in (2, 2, 2, 3, 5):
        for _ in range(60):
            words = []
            while len(words) < dice.randrange(5, 120):
                part = [dice.choice("abcde"[:letters]) for _ in range(dice.randrange(1, 9))]
                words += part * dice.choice([1, 1, 2, 4, 5, 9]) + part[:dice.randrange(0, len(part))]
            texts.append(" ".join(words))
    fib = ["a", "ab"]
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    texts += [" ".join(fib[-1]), " ".join(morse), " ".join(morse[:300] * 5)]
    texts.append(" ".join(f"w{i % 700}" for i in range(2900)) + " tail")
    return texts


@pytest.mark.parametrize("slice_words", [40, op.SLICE_WORDS])
def test_runs_of_lines(monkeypatch, slice_words):
    """All texts as one line, or each as a line of its own."""
    texts = [(t or "").encode().split() for t in _texts()]
    size = 1 if slice_words == 40 else len(texts)
    for i in range(0, len(texts), size):
        for words, found in zip(texts[i:i + size], op.runs_of_texts(texts[i:i + size])):
            assert [tuple(r) for r in found.tolist()] == _runs(words)


def test_query(spark, tmp_path):
    texts = _texts()
    rows = list(enumerate(texts)) + [(None, texts[20] + " and more"), (None, None), (8, texts[8]), (8, texts[8])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame = frame.withColumns({c: F.lit(c) for c in ("runs", "best", "collapsed", "start", "period", "n_words")})
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, (_expected(*r) for r in rows)))
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 20


def test_words_and_spans_leave_the_operator(spark):
    rows = spark.createDataFrame([("k", "so so so so so so it goes"), (None, None)], "doc_id string, text string")
    found = {r.doc_id: r for r in op.find_runs(rows).collect()}
    assert found["k"].collapsed == "so it goes" and [tuple(r) for r in found["k"].runs] == [(0, 6, 1)]
    assert found[None].runs == [] and found[None].best is None and found[None].collapsed == "" and found[None].n_words == 0
    assert op.find_runs(rows.limit(0)).count() == 0


def test_neighbours_by_brute_force():
    dice = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 257):
        array = dice.permutation(n).astype(np.int32)
        low, high = np.sort(dice.integers(0, n, (2, 60)), axis=0)
        high += 1
        values = np.array([dice.choice(array[a:b]) for a, b in zip(low, high)], np.int64)
        below, above = op.neighbours(array, low, high, values)
        for a, b, v, x, y in zip(low, high, values, below, above):
            own = sorted(array[a:b].tolist())
            at = own.index(v)
            assert (x, y) == (own[at - 1] if at else -1, own[at + 1] if at + 1 < len(own) else -1)


def test_a_long_text_takes_time_in_proportion():
    words = [f"w{i % 5000}".encode() for i in range(400_000)]
    started = time.process_time()
    assert op.runs_of_texts([words])[0].tolist() == [[0, 400_000, 5000]]
    assert time.process_time() - started < 60
