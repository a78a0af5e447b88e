"""Trees, proofs and folded roots against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from runtrace.llm import merkle as op
from runtrace.llm import queries


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    said = (None if v is None else str(v) for v in (row[0], row[3], row[2], row[4], row[1]))
    return _h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in said))


def _climb(nodes):
    """Root and, for each node, its (left, right) siblings."""
    at, paths, level = list(range(len(nodes))), [[] for _ in nodes], list(nodes)
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for k, place in enumerate(at):
            run, slot = runs[place // 3], place % 3
            paths[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[k] = place // 3
        level = [_h(*run) for run in runs]
    return level[0], paths


def _expected(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[3], []).append(row)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = []
    for name in names:
        own = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        built.append((own, *_climb([_leaf(r) for r in own])))
    root, above = _climb([b[1] for b in built])
    found = []
    for (own, subroot, paths), up in zip(built, above):
        for row, path in zip(own, paths):
            whole, text = path + up, row[1]
            if zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = _leaf((row[0], text, *row[2:]))
            for left, right in whole:
                node = _h(left, node, right)
            found.append((row[0], _leaf(row), subroot, root, _h(*(a + b for a, b in whole)), node, node == root))
    return found


def _frame(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return frame.withColumns({c: F.lit(c) for c in ("place", "rank", "tree", "node", "path", "leaf", "n", "group_size", "tie__")})


def _rows():
    dice = random.Random(5)
    rows = [(i, dice.choice(["a\nb", "é\n\nü", "", "x", None, "long " * 3000 + "\n"]), dice.choice(["xa", None]),
             dice.choice(["hot"] * 5 + ["é", "z", "Z", None, ""]), dice.choice([1, None])) for i in range(260)]
    rows += [(900 + i, "one\nof its own", None, f"s{i}", 3) for i in range(9)]
    return rows + rows[4:7] + [rows[4], (4, "other\ntext", None, rows[4][3], 1), (None, "no\nid", None, "hot", None), (None, None, None, None, None)]


@pytest.mark.parametrize("levels", [1, 2, op.LEVELS])
def test_every_proof(spark, levels):
    rows = _rows()
    made = op.verified(op.manifest(_frame(spark, rows), queries.without_breaks(), levels))
    got = made.select("doc_id", "leaf", "subroot", "root", op.proof_digest(F.col("path")), "folded_root", "verified").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _expected(rows)))
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("count", [0, 1, 2, 3, 4, 9, 10])
def test_small_tables(spark, tmp_path, count):
    rows = [(i, "a\n", "xa", "one" if count < 9 else f"s{i}", 2) for i in range(count)]
    _frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_merkle_manifest(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(_expected(rows) if rows else [])


def test_no_window_over_a_whole_source(spark):
    """Only the ranges themselves, a row each, are ordered in one place."""
    order = op.ordered(_frame(spark, _rows()).select("doc_id", "source"), ["source"], ["doc_id"])
    plan = order.rows()._jdf.queryExecution().toString()
    assert "range__no" in plan and "SinglePartition" not in plan
