"""Scores against counts in dictionaries."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from runtrace.llm import lm

TEXTS = [
    (1, "the cat sat on the mat the end"), (2, None), (3, ""), (4, "The CAT\tsat\n\nÉcole école the the the"), (None, "on the mat"),
    (5, "a b a b a b a b"), (5, "a b a b a b a b"), (6, "unknown words here the cat"), (7, " \t "), (8, "the " * 400),
]


def _tokens(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["</end>"]


def _expected(rows, learns):
    words, pairs = Counter(), Counter()
    for i, text in rows:
        if learns(i):
            t = _tokens(text)
            words.update(t)
            pairs.update(zip(["</end>", *t], t))
    n, v = sum(words.values()), len(words)
    for i, text in rows:
        t = _tokens(text)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in t)
        score = sum(math.log10((pairs[h, w] + lm.MASS * (words[w] + 1) / (n + v + 1)) / (words[h] + lm.MASS))
                    for h, w in zip(["</end>", *t], t))
        yield i, len(t), sum(words[w] > 0 for w in t), n, base, score


@pytest.mark.parametrize("hot, chunk, shard", [(512, 1_500_000, 3_000_000), (4, 20, 50), (1, 1, 1), (0, 30, 100)])
def test_scores(spark, monkeypatch, hot, chunk, shard):
    monkeypatch.setattr(lm, "HOT", max(hot, 1e-9))
    monkeypatch.setattr(lm, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(lm, "SHARD_TOKENS", shard)
    rows = [(i, t) for i, t in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    learnable = F.coalesce(F.col("doc_id") != 6, F.lit(True))
    got = sorted(map(tuple, lm.score(docs, learnable).collect()), key=lambda r: (r[0] is None, r))
    want = sorted(_expected(rows, lambda i: i != 6), key=lambda r: (r[0] is None, r))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4]
        assert g[4] == pytest.approx(w[4], abs=1e-9)
        assert g[5] == pytest.approx(w[5], abs=1e-3 * w[1])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = lm.score(docs, F.lit(False)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    assert all(abs(r.score) < 1e-9 and r.base_score == 0 for r in rows)
    assert lm.score(docs.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("at_once", [10_000, 50_000])
def test_many_short_texts_behind_long_ones(spark, at_once):
    long = [(i, " ".join(f"v{(i + k) % 7}" for k in range(150))) for i in range(7_000)]
    rows = long + [(i, f"w{i % 97} x{i % 89}") for i in range(7_000, 41_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, at_once)
    try:
        got = sorted(map(tuple, lm.score(docs, F.col("doc_id") % 5 != 0).collect()))
    finally:
        spark.conf.set(name, before)
    want = list(_expected(rows, lambda i: i % 5 != 0))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert max(abs(g[4] - w[4]) for g, w in zip(got, want)) < 1e-6
    assert all(abs(g[5] - w[5]) <= 1e-3 * w[1] for g, w in zip(got, want))
