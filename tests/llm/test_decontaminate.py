"""Hits against a scan of every place in plain Python."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from runtrace.llm import decontaminate as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def _expected(text, items):
    words, hit, found = _words(text), set(), set()
    for item, said in items:
        own = _words(said)
        for i in range(max(len(own) - 12, 1) if own else 0):
            window = own[i:i + 13]
            for at in range(len(words) - len(window) + 1):
                if words[at:at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), ",".join(sorted(found))


def _tables(spark):
    dice = random.Random(3)
    pool = ["the", "of", "Éa", "x1", "naïve", "a", "b_c", "Long-word"]
    some = lambda n: " ".join(dice.choice(pool) for _ in range(n))
    items = [(i, some(dice.randrange(0, 30))) for i in range(12)] + [(3, "the of"), (None, "a a"), (20, None), (21, " .. ")]
    items += [(30, " ".join(f"w{i}" for i in range(40))), (31, " ".join(f"w{i}" for i in range(10, 40)))]
    texts = [some(dice.randrange(0, 60)) + " " + (dice.choice(items)[1] or "") + "! " + some(dice.randrange(0, 20)) for _ in range(40)]
    texts += [None, "", "...", "The OF", items[-2][1].upper() + " tail", "w " * 5000 + items[-1][1], "The OF", "w1 w2"]
    docs = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    docs += docs[5:8]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    frame = frame.withColumns({"text_hash": F.lit("mine"), "words": F.lit(1), "pos": F.lit(2), "n_hit": F.lit(3)})
    return docs, items, frame, spark.createDataFrame(items, "item_id bigint, text string")


def test_contamination(spark):
    docs, items, frame, benchmark = _tables(spark)
    for at_once in (op.WINDOWS_AT_ONCE, 7):
        rows = op.contamination(frame, benchmark, at_once).collect()
        got = sorted((r.doc_id is None, r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in rows)
        assert got == sorted((i is None, i, *_expected(t, items)) for i, t in docs)


def test_rows_and_spans_that_stay(spark):
    docs, items, frame, benchmark = _tables(spark)
    kept = sorted(map(str, ((r.doc_id, r.text) for r in op.without_contaminated(frame, benchmark).collect())))
    bad = lambda t: (lambda n, h, _: h > 0 and 20 * h >= n)(*_expected(t, items))
    assert kept == sorted(map(str, (d for d in docs if not bad(d[1]))))
    cut = op.without_spans(frame, benchmark)
    assert cut.columns == frame.columns and {r.text_hash for r in cut.collect()} == {"mine"}
    left = sorted(len(_words(r.text)) for r in cut.collect())
    assert left == sorted(n - h for n, h, _ in (_expected(t, items) for _, t in docs))


def test_empty_tables(spark):
    _, _, frame, benchmark = _tables(spark)
    assert op.contamination(frame.limit(0), benchmark).count() == 0
    assert op.contamination(frame, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_no_python_in_the_plan(spark):
    _, _, frame, benchmark = _tables(spark)
    plan = op.contamination(frame, benchmark)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_words_are_the_contracts_and_found_fast(spark):
    every = "".join(chr(c) for c in [*range(0x2FFF), 0xFFFD, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF])
    cased = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    one = spark.createDataFrame([(every,), (None,)], "text string")
    got = one.select(op.words_of("text").alias("low"), F.regexp_extract_all("text", F.lit(op.CASED_WORD), F.lit(0)).alias("cased")).collect()
    assert got[0].low == _words(every) and got[0].cased == cased.findall(every) and got[1].low == []

    text = "Anblewh sttible ñathawh thonre, was is anly 42 hend oftionnten. " * 30_000
    texts = spark.createDataFrame([(text,)] * 4, "text string").repartition(1).cache()

    def seconds(word):
        began = time.perf_counter()
        assert texts.select(F.sum(F.size(F.regexp_extract_all("text", F.lit(word), F.lit(0))))).first()[0] > 0
        return time.perf_counter() - began

    texts.count()
    try:
        assert min(seconds(op.CASED_WORD) for _ in range(3)) < 0.6 * min(seconds(cased.pattern) for _ in range(3))
    finally:
        texts.unpersist()
