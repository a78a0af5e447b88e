"""Documents with a planted word somewhere: held-out accuracy, and where the word is found."""

from __future__ import annotations

import math
import random
import re

from pyspark.sql import functions as F

from runtrace.llm import toxicity as op
from runtrace.llm.textbytes import Slice


def _docs(spark, n=600):
    dice = random.Random(2)
    pool = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("ra", "sen", "tik", "vo", "é")]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(dice.choice(pool) for _ in range(dice.randrange(2, 9))) for _ in range(dice.randrange(1, 20))]
        bad = i % 4 == 0
        if bad:
            at = dice.randrange(len(sentences))
            sentences[at] += f" {dice.choice(['grukh', 'Zwolt', 'PRAXXen', 'praxxol', 'praxxum'])}"
        rows.append((i, ". ".join(sentences) + "!"))
        labels.append((i, int(bad)))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"toxic": F.lit("mine"), "score": F.lit(1)}), labels


def _plainly(text, model):
    """One minus the chance that no sentence is toxic, sentence by sentence and word by word."""
    clean = 1.0
    for sentence in re.split(r"[\n!.?]", text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", sentence)
        if words:
            numbers = [n for word in words for n in op.features(Slice([word.encode()]))[2][0] if n >= 0]
            clean *= 1 - 1 / (1 + math.exp(-(model.bias + sum(float(model.weights[n]) for n in numbers))))
    return 1 - clean


def test_scores_by_a_plain_loop(spark):
    rows, docs, labels = _docs(spark, 240)
    model = op.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.lit(True))
    assert model.constant is None
    found = {r.doc_id: r.score for r in op.score(docs, model).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        assert abs(found[i] - _plainly(text, model)) < 1e-6


def test_held_out_documents(spark):
    rows, docs, labels = _docs(spark)
    learned = spark.createDataFrame([*labels, labels[0], (7, None), (None, 1), (5000, 1)], "doc_id bigint, toxic int")
    model = op.train(docs, learned, F.col("doc_id") % 5 != 1)
    found = {r.doc_id: r for r in op.score(docs, model).collect()}
    toxic = dict(labels)
    held = [i for i, _ in rows if i % 5 == 1]
    assert sum((found[i].score >= 0.3) == bool(toxic[i]) for i in held) >= 0.98 * len(held)
    texts = dict(rows)
    said = [texts[i][s.start:s.end].lower() for i in held if toxic[i] for s in found[i].sentences]
    assert said and sum(any(w in t for w in ("grukh", "zwolt", "praxx")) for t in said) >= 0.98 * len(said)
    assert not any("." in t for t in said)


def test_odd_rows(spark):
    rows, docs, labels = _docs(spark, 200)
    model = op.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.lit(True))
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " .!? "), (None, "grukh"), (4, "grukh"), (4, "grukh"), (5, "ka " * 50_000)], "doc_id bigint, text string")
    found = sorted(((r.doc_id is None, r.doc_id or 0, r.score) for r in op.score(odd, model).collect()))
    assert len(found) == 7 and [s for _, _, s in found[:3]] == [0, 0, 0]
    assert found[3][2] == found[4][2] == found[6][2] and 0 <= found[5][2] <= 1
    assert op.score(odd.limit(0), model).count() == 0


def test_one_class_or_none(spark):
    rows, docs, labels = _docs(spark, 40)
    none = op.train(docs, spark.createDataFrame([], "doc_id bigint, toxic int"), F.lit(True))
    assert {r.score for r in op.score(docs, none).collect()} == {0.0}
    ones = op.train(docs, spark.createDataFrame([(i, 1) for i, _ in labels], "doc_id bigint, toxic int"), F.lit(True))
    assert {r.score for r in op.score(docs, ones).collect()} == {1.0}
