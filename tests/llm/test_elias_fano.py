"""Successor search against numpy on plain arrays."""

from __future__ import annotations

import numpy as np
import pytest

from runtrace.llm.elias_fano import EliasFano, NgramTrie


@pytest.mark.parametrize("n, top", [(0, 10), (1, 1), (5, 6), (1000, 2**63), (3000, 4000), (200, 2**64 - 1), (70_000, 2**40)])
def test_successor(n, top):
    dice = np.random.default_rng(n)
    values = np.unique(dice.integers(0, top, n, dtype=np.uint64, endpoint=True))
    some = dice.integers(0, top, 500, dtype=np.uint64, endpoint=True)
    bounds = np.concatenate([values[:3000], some, np.array([0, top], np.uint64)])
    index, equal = EliasFano.of(values).successor(bounds)
    assert (index == np.searchsorted(values, bounds)).all()
    assert (equal == np.isin(bounds, values)).all()


def test_trie_from_a_mapped_file():
    nodes = np.array([3, 9, 2**63], np.uint64)
    place = np.array([0, 0, 1, 2, 2])
    child = np.array([5, 2**62, 5, 1, 7], np.uint64)
    values = np.array([-1.5, -2.0, -0.25, -3.0, -7.0])
    trie = NgramTrie.build(nodes, np.array([4, 1, 9]), np.array([-1.0, -2.0, -3.0]), place, child, values).mapped()
    there, found = trie.child(np.array([3, 3, 9, 2**63, 2**63, 9, 4], np.uint64), np.array([5, 2**62, 5, 1, 7, 7, 5], np.uint64))
    assert there.tolist() == [True] * 5 + [False] * 2
    assert np.allclose(found[:5], values, atol=1e-4) and not found[5:].any()
    has, counts, own = trie.node(np.array([9, 10], np.uint64))
    assert has.tolist() == [True, False] and counts.tolist() == [1, 0] and abs(own[0] + 2) < 1e-4
