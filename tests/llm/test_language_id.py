"""Held-out accuracy on the test tables, and texts that no language model should touch."""

from __future__ import annotations

import math
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from runtrace.llm import language_id as op
from runtrace.llm.textbytes import slices

SYLLABLES = {"xa": ["ka", "lu", "tor", "mim", "ash"], "yb": ["schen", "üng", "keit", "zu", "ver"], "zc": ["ción", "ña", "ez", "rro", "ll"]}


def _text(dice, language, words):
    return " ".join("".join(dice.choice(SYLLABLES[language]) for _ in range(dice.randrange(1, 4))) for _ in range(words))


def _docs(spark):
    dice = random.Random(1)
    rows = [(i, _text(dice, lang, dice.randrange(5, 120)), lang) for i, lang in enumerate([*SYLLABLES] * 60)]
    rows += [(900, None, "xa"), (901, "", "xa"), (902, "123 !?", "yb"), (903, "ka lu torash", None), (904, "ünG", None), (None, "ción ezrro ñall", None)]
    rows += [(905, "слово и дело в языке которого нет среди прочих " * 8, None), (906, _text(dice, "yb", 30_000), "yb"), rows[4], rows[4]]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumns({"key": F.lit(1), "score": F.lit("s"), "share": F.lit(2)})


def test_predictions(spark):
    rows, docs = _docs(spark)
    model = op.train(docs, F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0)
    assert set(model.languages) == set(SYLLABLES) and (model.centroids.shape[0] <= 9)
    found = op.predict(docs, model).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    right = [by_id[i].lang_pred == lang for i, _, lang in rows if i is not None and i < 900]
    assert sum(right) >= 0.99 * len(right)
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and all(by_id[i].score == 0 for i in (900, 901, 902))
    assert by_id[903].lang_pred == "xa" and by_id[None].lang_pred == "zc" and by_id[906].lang_pred == "yb"
    assert by_id[905].rejected and not by_id[904].rejected and by_id[905].lang_pred in SYLLABLES
    assert all(0 <= r.score <= 1 for r in found)


def _plainly(text, model):
    """Language, cosine and rejection by a loop over the trigrams of one text."""
    said = [(c + 32 if 65 <= c <= 90 else c) for c in text.encode()]
    letters = [32, *[c if c >= 128 or 97 <= c <= 122 else 32 for c in said], 32]
    counts: dict[int, int] = {}
    for before, letter, after in zip(letters, letters[1:], letters[2:]):
        if letter != 32:
            key = ((before << 16 | letter << 8 | after) * 0x9E3779B1 % 2**32) >> 18
            counts[key] = counts.get(key, 0) + 1
    weights = {key: math.log1p(n) * float(model.idf[key]) for key, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in weights.values())) or 1.0
    cosines = [sum(w * float(centre[key]) for key, w in weights.items()) / norm for centre in model.centroids]
    best = max(range(len(cosines)), key=cosines.__getitem__)
    floor = float(model.floors[min(int(math.log2(max(sum(counts.values()), 1))), len(model.floors) - 1)])
    return model.languages[model.owner[best]], max(cosines[best], 0.0), floor


def test_the_order_of_rows_changes_nothing(spark):
    _, docs = _docs(spark)
    one, two = (op.train(rows, F.lit(True)) for rows in (docs, docs.repartition(7, F.rand(3))))
    assert one.languages == two.languages and np.array_equal(one.centroids, two.centroids) and np.array_equal(one.floors, two.floors)


def test_predictions_by_a_plain_loop(spark):
    rows, docs = _docs(spark)
    model = op.train(docs, F.lit(True))
    texts = {i: t for i, t, _ in rows if t and i is not None and i < 906}
    found = {r.doc_id: r for r in op.predict(docs, model).collect()}
    checked = 0
    for i, text in texts.items():
        lang, score, floor = _plainly(text, model)
        if not any(map(str.isalpha, text)):
            continue
        assert found[i].lang_pred == lang and abs(found[i].score - score) < 1e-4
        if abs(score - floor) > 1e-4:
            assert found[i].rejected == (score < floor)
        checked += 1
    assert checked > 180


def test_only_rejected_rows_go(spark):
    rows, docs = _docs(spark)
    kept = op.without_rejected(docs, op.train(docs, F.lit(True)))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in (900, 901, 902, 905))


def test_texts_without_letters_teach_nothing(spark):
    """A language of empty texts only is not learned, and has no part in what is predicted."""
    rows = [(i, _text(random.Random(i), "xa", 20), "xa") for i in range(30)] + [(50 + i, t, "empty") for i, t in enumerate(["", " ", "12 34", "!?"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = op.train(docs, F.lit(True))
    assert model.languages == ["xa"]
    assert {r.lang_pred for r in op.predict(docs, model).collect()} == {"xa", "und"}


def test_many_short_texts_take_little_memory(spark):
    """Ten thousand titles are one Arrow batch; what is dense holds a few texts at a time."""
    rows, docs = _docs(spark)
    model = op.train(docs, F.lit(True))
    dice = random.Random(4)
    titles = pa.array([_text(dice, "yb", 3) for _ in range(10_000)])
    tracemalloc.start()
    found = [op._judged(part, model)[0] for _, part in slices(iter([pa.record_batch([titles], names=["text"])]), size=op._BYTES, most=op._TEXTS)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, found)) == 10_000 and max(map(len, found)) <= op._TEXTS
    assert peak < 60_000_000


def test_nothing_to_learn_from(spark):
    _, docs = _docs(spark)
    model = op.train(docs, F.lit(False))
    assert model is None and {r.lang_pred for r in op.predict(docs, model).collect()} == {"und"}
    assert op.without_rejected(docs, None).where("doc_id = 903").count() == 1
    assert op.predict(docs.limit(0), op.train(docs.limit(0), F.lit(True))).count() == 0


def test_fitting_holds_the_vectors_of_a_language_once():
    dice = np.random.default_rng(4)
    counts = np.zeros((600, op.FEATURES), np.float32)
    for row in counts:
        row[dice.integers(0, op.FEATURES, 900)] = dice.integers(1, 9, 900)
    idf = (1 + dice.random(op.FEATURES)).astype(np.float32)
    rows = pd.DataFrame([op._sparse(row) for row in counts], columns=["at", "counts"])
    whole = op.weigh(counts, idf)
    expected = op._centroids(whole, 3)
    floors = op._floors(counts[::6], idf, expected)
    chosen = dice.random(600) < 0.4
    assert np.array_equal(op._mean(whole, chosen), whole[chosen].mean(axis=0))
    tracemalloc.start()
    centres, far = op._fitted(rows, idf, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(centres, expected) and np.array_equal(far, floors)
    assert peak < 2 * whole.nbytes
