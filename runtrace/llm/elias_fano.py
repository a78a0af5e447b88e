"""Elias-Fano sequences and a two-level trie of them, in files that are mapped into memory.

A sequence of n rising values below u keeps the low log2(u / n) bits of each value packed, and the rest as gaps in a bit
vector: about 2 + log2(u / n) bits a value. The first value that is not below a bound is found by selecting the
zeros of the bit vector around the bound's high part, and by bisecting the few values between them. All
searches are for many bounds at once.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

_ONE = np.uint64(1)
#: Bounds that are looked up at once, for the unpacked bits of as many words.
_AT_ONCE = 1 << 16


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of `width` bits, one after another in 64-bit words."""
    words = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width == 0 or len(values) == 0:
        return words
    at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    firsts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    words[word[firsts]] = np.bitwise_or.reduceat(values << shift, firsts)
    over = np.flatnonzero(shift + np.uint64(width) > 64)
    words[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return words


class EliasFano:
    """A strictly rising sequence of 64-bit values."""

    PARTS = ("head", "low", "high", "zeros")

    def __init__(self, head: np.ndarray, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.head, self.low, self.high, self.zeros = head, low, high, zeros
        self.n, self.width = int(head[0]), int(head[1])
        self.mask = (_ONE << np.uint64(self.width)) - _ONE if self.width < 64 else ~np.uint64(0)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(63, max(0, ((top + 1) // max(n, 1)).bit_length() - 1))
        mask = (_ONE << np.uint64(width)) - _ONE
        over = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros(-(-(n + (top >> width) + 2) // 64) * 64, bool)
        bits[over + np.arange(n)] = True
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        zeros = np.concatenate([[0], np.cumsum(64 - bits.reshape(-1, 64).sum(axis=1))]).astype(np.int64)
        return cls(np.array([n, width], np.int64), _pack(values & mask, width), high, zeros)

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, p) for p in self.PARTS]

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if self.width == 0:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        left = (self.low[word + 1] << _ONE) << (np.uint64(63) - shift)
        return ((self.low[word] >> shift) | left) & self.mask

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero of the bit vector, counted from 0."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        bits = np.unpackbits((~self.high[word]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        nth = (k - self.zeros[word] + 1).astype(np.uint8)
        return word * 64 + (np.cumsum(bits, axis=1, dtype=np.uint8) >= nth[:, None]).argmax(axis=1)

    def successor(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value that is not below each bound (n if none), and whether it equals the bound."""
        index, equal = np.zeros(len(bounds), np.int64), np.zeros(len(bounds), bool)
        for a in range(0, len(bounds), _AT_ONCE):
            index[a:a + _AT_ONCE], equal[a:a + _AT_ONCE] = self._successor(bounds[a:a + _AT_ONCE])
        return index, equal

    def _successor(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.n == 0 or len(bounds) == 0:
            return np.zeros(len(bounds), np.int64), np.zeros(len(bounds), bool)
        over = (bounds >> np.uint64(self.width)).astype(np.int64)
        last = int(self.zeros[-1]) - 1
        within = over < last
        over = np.minimum(over, last - 1)
        end = self._zero(over) - over
        start = np.where(over > 0, self._zero(np.maximum(over - 1, 0)) - over + 1, 0)
        low = bounds & self.mask
        stop = end.copy()
        while len(open_ := np.flatnonzero(start < stop)):
            middle = (start[open_] + stop[open_]) // 2
            below = self._lows(middle) < low[open_]
            start[open_[below]] = middle[below] + 1
            stop[open_[~below]] = middle[~below]
        found = (start < end) & within
        equal = np.zeros(len(bounds), bool)
        equal[found] = self._lows(start[found]) == low[found]
        return np.where(within, start, self.n), equal


class NgramTrie:
    """Nodes, and under each node its children, all as Elias-Fano sequences; a quantised value for each node and child.

    A child is known by its rank among all different children, relative to its node: node rank * children + child rank is
    one rising sequence, in which a node's children are searched. Node counts are kept whole.
    """

    _VALUES = ("counts", "node_codes", "child_codes", "scales")

    def __init__(self, nodes: EliasFano, children: EliasFano, links: EliasFano, counts, node_codes, child_codes, scales):
        self.nodes, self.children, self.links = nodes, children, links
        self.counts, self.node_codes, self.child_codes, self.scales = counts, node_codes, child_codes, scales

    @staticmethod
    def _quantise(values: np.ndarray) -> tuple[np.ndarray, list[float]]:
        low, high = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
        step = (high - low) / 65535 or 1.0
        return np.round((values - low) / step).astype(np.uint16), [low, step]

    @classmethod
    def build(cls, nodes: np.ndarray, counts: np.ndarray, node_values: np.ndarray, pair_node: np.ndarray,
              pair_child: np.ndarray, pair_values: np.ndarray) -> NgramTrie:
        """Nodes rise; pairs are of node places and child hashes, in order of both, and hold at least one child a node."""
        children = np.unique(pair_child)
        links = pair_node.astype(np.uint64) * np.uint64(max(len(children), 1)) + np.searchsorted(children, pair_child).astype(np.uint64)
        node_codes, a = cls._quantise(node_values)
        child_codes, b = cls._quantise(pair_values)
        return cls(EliasFano.of(nodes), EliasFano.of(children), EliasFano.of(links), counts.astype(np.int64), node_codes, child_codes, np.array(a + b))

    def mapped(self) -> NgramTrie:
        """The same trie, read from a file that is mapped into memory and goes when it is no longer used."""
        arrays = [x for ef in (self.nodes, self.children, self.links) for x in ef.parts()] + [getattr(self, v) for v in self._VALUES]
        handle, path = tempfile.mkstemp(suffix=".trie")
        try:
            with os.fdopen(handle, "wb") as file:
                places = []
                for x in arrays:
                    file.write(b"\0" * (-file.tell() % 8))
                    places.append((file.tell(), x.dtype, len(x)))
                    file.write(np.ascontiguousarray(x).tobytes())
            whole = np.memmap(path, np.uint8, "r")
        finally:
            os.unlink(path)
        views = [whole[at: at + n * kind.itemsize].view(kind) for at, kind, n in places]
        return NgramTrie(*[EliasFano(*views[4 * i: 4 * i + 4]) for i in range(3)], *views[12:])

    def node(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which nodes there are, their counts (0 if not there) and values (0 if not there)."""
        place, there = self.nodes.successor(hashes)
        count, value = np.zeros(len(hashes), np.int64), np.zeros(len(hashes))
        count[there] = self.counts[place[there]]
        value[there] = self.scales[0] + self.scales[1] * self.node_codes[place[there]]
        return there, count, value

    def child(self, nodes: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each child is under its node, and its value (0 if not): a search among the node's children only."""
        node, has_node = self.nodes.successor(nodes)
        rank, has_child = self.children.successor(children)
        maybe = np.flatnonzero(has_node & has_child)
        link = node[maybe].astype(np.uint64) * np.uint64(max(self.children.n, 1)) + rank[maybe].astype(np.uint64)
        place, same = self.links.successor(link)
        there, value = np.zeros(len(nodes), bool), np.zeros(len(nodes))
        there[maybe[same]] = True
        value[maybe[same]] = self.scales[2] + self.scales[3] * self.child_codes[place[same]]
        return there, value
