"""Counts against plain Python, and rows that stand out of their group."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from runtrace.llm import quality as op


def _counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often, hit = Counter(triples), set()
    for i, t in enumerate(triples):
        if often[t] > 1:
            hit.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def _docs(spark):
    dice = random.Random(5)
    pool = ["".join(dice.choice("abcdeé") for _ in range(dice.randrange(2, 9))) for _ in range(3000)]
    line = lambda: " ".join(dice.choice(pool) for _ in range(dice.randrange(4, 12)))
    rows = []
    for i in range(900):
        text = "\n".join(line() for _ in range(dice.randrange(8, 60)))
        rows.append((i, text, "aa" if i % 3 else None, f"s{i % 2}" if i < 880 else f"rare{i}"))
    junk = [(2000, " ".join(f"{w}%%%" for w in dice.sample(pool, 200)), "aa", "s0"), (2001, " | ".join(dice.sample(pool, 100)), "aa", "s1"),
            (2002, "one two three four five six seven\n" * 20, "aa", "s0"), (2003, "\n".join([line()] * 4 + [line() for _ in range(4)]), "aa", "s0")]
    odd = [(3000, None, "aa", "s0"), (3001, "", None, None), (3002, "\n \n x \n x", "aa", "s1"), (None, rows[0][1], "aa", "s1"),
           (3003, rows[1][1], None, None), (3004, "z " * 40_000, "bb", "s9"), rows[2], rows[2], (3005, "a b a b a b", "aa", "s0")]
    rows += junk + odd
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return rows, docs.withColumns({"row": F.lit("mine"), "group": F.lit(1), "n": F.lit(2), "n_words": F.lit(3)})


def test_counts_and_verdicts(spark):
    rows, docs = _docs(spark)
    found = op.judge(docs).collect()
    names = op.COUNTS[:5]
    assert sorted((str(r.doc_id), *[r[c] for c in names]) for r in found) == sorted((str(i), *_counts(t)) for i, t, _, _ in rows)
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    by_id = {r.doc_id: r for r in found}
    assert not any(by_id[i].kept for i in (2000, 2001, 2002))
    clean = [r for r in found if r.doc_id is not None and r.doc_id < 900 and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)


def test_mostly_repeated_lines(spark):
    _, docs = _docs(spark)
    dice = random.Random(9)
    word = lambda: "".join(dice.choice("abcde") for _ in range(5))
    lines = [" ".join(word() for _ in range(8)) for _ in range(30)]
    repeated = "\n".join(f"{x}\nmenus\nmenus" for x in lines) + "\n"
    control = "\n".join(f"{x}\n{word()} {i}\n{word()} {i}x" for i, x in enumerate(lines)) + "\n"
    more = spark.createDataFrame([(5000, repeated, "aa", "s0"), (5001, control, "aa", "s0")], "doc_id bigint, text string, lang string, source string")
    found = {r.doc_id: r for r in op.judge(docs.select(more.columns).union(more)).where("doc_id >= 5000").collect()}
    assert 0.6 < found[5000].n_dup_lines / 90 < 0.7 and not found[5000].base_failed
    assert not found[5000].kept and found[5001].kept


def test_small_tables(spark):
    _, docs = _docs(spark)
    assert op.judge(docs.limit(0)).count() == 0
    few = op.judge(docs.where("doc_id < 5")).collect()
    assert all(r.kept != r.base_failed and r.distance is None for r in few)


def test_distribution_tools():
    assert abs(op.chi_squared(0.95, 5) - 11.07) < 0.1
    assert op._consistency(1.0, 5) == np.float64(1) or abs(op._consistency(1.0, 5) - 1) < 0.01
