"""Segmentation against listing every path, and exact round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from runtrace.llm import pieces

TEXTS = ["", " ", "  a  b\n\tc é ▁x 中文😀", "the theatre\n\nThe  end. ", "a" * 200, "x" * 70 + " y", "▁", "naïve café œuvre", "\u0000 "]


@pytest.fixture(scope="module")
def words():
    return pieces.load()


def _all_paths(lattice, node):
    if node == 0:
        return [(0, [])]
    return [(score + before, ids + list(own)) for start, score, own in lattice.into[node] for before, ids in _all_paths(lattice, start)]


def test_n_best_lists_the_best_paths(words):
    dice = random.Random(1)
    for _ in range(60):
        text = "".join(dice.choice("atheinor s\néx") for _ in range(dice.randrange(0, 9))).encode()
        every = sorted(_all_paths(pieces.unit_lattice(b" " + text, words), len(text) + 1), key=lambda p: -p[0])
        found = pieces.encode_slice([text], words, 5)
        assert [s for s, _ in found.n_best[0]] == [s for s, _ in every[:5]], text
        ids = [tuple(found.path_ids(path)) for _, path in found.n_best[0]]
        assert len(set(ids)) == len(ids) and set(ids) <= {tuple(i) for _, i in every}
        assert found.scores[0] == every[0][0] and tuple(found.ids.tolist()) in {tuple(i) for s, i in every if s == every[0][0]}


def test_long_units_are_segmented_like_short_ones(words):
    dice = random.Random(2)
    units = [b" " + "".join(dice.choice("athe inor").replace(" ", "q") for _ in range(dice.randrange(1, 40))).encode() for _ in range(50)]
    found = pieces.encode_slice([u[1:] for u in units], words, 2)
    for i, unit in enumerate(units):
        ids, score, gap = pieces._segment_long(unit, words)
        assert found.scores[i] == score and found.ids[found.places[i]:found.places[i + 1]].tolist() == ids
        best = [s for s, _ in found.n_best[i]]
        assert len(best) == 1 or best[0] - best[1] == gap


def test_round_trip(words):
    found = pieces.encode_slice([t.encode() for t in TEXTS], words, 3)
    for i, text in enumerate(TEXTS):
        assert pieces.decode(found.ids[found.places[i]:found.places[i + 1]].tolist(), words).decode() == text
        for _, path in found.n_best[i]:
            assert pieces.decode(found.path_ids(path), words).decode() == text


def test_rows(spark, words):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "of it"), (4, "of it"), (4, "of it"), (5, "y" * 50_000)], "doc_id bigint, text string")
    rows = {(r.doc_id, r.n_pieces): r for r in pieces.encode(docs, words).collect()}
    assert rows[(1, 0)].ids is None and rows[(1, 0)].score is None
    assert all(r.round_trip for r in rows.values() if r.score is not None)
    assert pieces.encode(docs, words).count() == 6
    assert pieces.encode(docs.limit(0), words).count() == 0
    text = rows[(None, next(n for i, n in rows if i is None))]
    assert pieces.decode(text.ids, words) == b"of it" and np.all(np.diff([b.score for b in text.n_best]) <= 0)
    for row in rows.values():
        for best in row.n_best or []:
            assert best.n_pieces == len(best.ids) and best.ids_sha256 == hashlib.sha256(np.array(best.ids, "<i4").tobytes()).hexdigest()
            assert pieces.decode(best.ids, words).decode() == {1: None, 2: "", 4: "of it", 5: "y" * 50_000, None: "of it"}[row.doc_id]
        if row.n_best:
            assert len({b.ids_sha256 for b in row.n_best}) == len(row.n_best)
            assert (row.score, row.ids, row.ids_sha256, row.n_pieces) == tuple(row.n_best[0][k] for k in ("score", "ids", "ids_sha256", "n_pieces"))
    assert len(text.n_best) == 3
    one = pieces.encode(docs.where("doc_id = 4"), words, n=1, with_ids=False).first()
    assert one.ids is None and one.n_best[0].ids is None and one.ids_sha256 == text.ids_sha256 and len(one.n_best) == 1
