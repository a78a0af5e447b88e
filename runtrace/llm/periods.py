"""Periodic runs of words in whole texts, found by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, at least max(6, 4 q) long, that no neighbouring word extends.
Texts of a slice stand one after another as one line of symbols: a symbol for each different word of a text, none shared between
texts, and one of its own behind each text. Nothing that repeats therefore spans two texts.

The line gets a suffix array by doubling: after step k, places with the same 2^k symbols ahead form a class, which is a stretch of
the array; only classes of two or more are sorted further. Level k looks at the line's dyadic blocks, 2^k symbols
from each multiple of 2^k. A run of period q, 2^(k-1) < q <= 2^k, is at least 4 q long and so holds a whole block and q words before or
behind it: the block occurs again exactly q words away, and nowhere nearer (two such distances would share a divisor
that is a period of the run). Period 1 is found at level 1 as well, since its runs have six words. The nearest occurrences of a block are the predecessor and the successor of its own place among
the array's entries of its class: a wavelet tree over the array counts the entries below it, and descends to the ones before and after.
Occurrences q apart are a progression with candidate period q. Each is extended both ways by comparing classes, longest first,
which gives the maximal stretch; stretches under the limit are dropped, and equal ones are one run.

The wavelet tree is rebuilt level by level for all queries at once, so it takes the space of two levels. Classes are kept for the levels
at which something repeats: for a text of n words that repeats a passage of m words, n log m numbers of four bytes.

Null and empty texts have no words and no run. Texts longer than a slice are slices of their own. Repeated rows are rows of their own.
An empty table gives no rows. Other columns are neither read nor kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
FIRST_LEVEL = 1
#: Words in a slice, about; one text is never cut.
SLICE_WORDS = 100_000

SPAN = "start:bigint,length:bigint,period:bigint"


@dataclass(frozen=True)
class Classes:
    """`at[k][i]`: where the class of place i by its 2^k symbols begins in the array; `sizes[k]`: its size, by that beginning."""

    array: np.ndarray
    at: list[np.ndarray]
    sizes: list[np.ndarray]


def suffix_classes(symbols: np.ndarray) -> Classes:
    """Classes of all levels with a repeat, and the suffix array. The line's last symbol occurs once."""
    n = len(symbols)
    array = np.argsort(symbols, kind="stable").astype(np.int32)
    first = np.flatnonzero(np.diff(symbols[array], prepend=symbols[array[0]] - 1))
    at = np.empty(n, np.int32)
    size = np.diff(np.append(first, n)).astype(np.int32)
    at[array] = np.repeat(first, size)
    sizes = np.zeros(n, np.int32)
    sizes[first] = size
    levels, all_sizes, step = [], [], 1
    while True:
        levels.append(at)
        all_sizes.append(sizes)
        begins = np.flatnonzero(sizes > 1)
        if not len(begins):
            return Classes(array, levels[:-1], all_sizes[:-1])
        lengths = sizes[begins]
        ends = np.cumsum(lengths)
        slots = np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1])
        places = array[slots]
        own = at[places].astype(np.int64)
        key = own * (n + 1) + at[np.minimum(places + step, n - 1)]
        order = np.argsort(key, kind="stable")
        key, places = key[order], places[order]
        array[slots] = places
        new = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
        counts = np.diff(np.append(new, len(key)))
        at, sizes = at.copy(), sizes.copy()
        sizes[begins] = 0
        sizes[slots[new]] = counts
        at[places] = np.repeat(slots[new], counts)
        step *= 2


def _halves(values: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One level of a wavelet tree: zeros before each place, the values dealt by their bit, and the number of zeros."""
    ones = ((values >> bit) & 1).astype(bool)
    zeros = np.zeros(len(values) + 1, np.int32)
    np.cumsum(~ones, out=zeros[1:])
    return zeros, np.concatenate([values[~ones], values[ones]]), int(zeros[-1])


def neighbours(array: np.ndarray, low: np.ndarray, high: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For queries of an entry among the entries from low up to high: the next smaller and the next larger one, or -1.

    `values` are entries of their stretches. First pass: how many entries of a stretch are smaller. Second: the entries that stand
    one before and one after in order.
    """
    bits = range(max(int(len(array) - 1).bit_length(), 1) - 1, -1, -1)
    dealt, left, right, smaller = array, low.astype(np.int64), high.astype(np.int64), np.zeros(len(low), np.int64)
    for bit in bits:
        zeros, dealt, middle = _halves(dealt, bit)
        up, left_zeros, right_zeros = ((values >> bit) & 1).astype(bool), zeros[left], zeros[right]
        smaller += np.where(up, right_zeros - left_zeros, 0)
        left, right = np.where(up, middle + left - left_zeros, left_zeros), np.where(up, middle + right - right_zeros, right_zeros)
    wanted = np.concatenate([smaller - 1, smaller + 1])
    valid = np.flatnonzero((wanted >= 0) & (wanted < np.tile(high - low, 2)))
    rank, left, right = wanted[valid], np.tile(low, 2)[valid].astype(np.int64), np.tile(high, 2)[valid].astype(np.int64)
    dealt, entry = array, np.zeros(len(valid), np.int64)
    for bit in bits:
        zeros, dealt, middle = _halves(dealt, bit)
        left_zeros, right_zeros = zeros[left], zeros[right]
        here = right_zeros - left_zeros
        up = rank >= here
        rank = np.where(up, rank - here, rank)
        entry |= up.astype(np.int64) << bit
        left, right = np.where(up, middle + left - left_zeros, left_zeros), np.where(up, middle + right - right_zeros, right_zeros)
    found = np.full(len(wanted), -1, np.int64)
    found[valid] = entry
    return found[:len(low)], found[len(low):]


def _agreement(classes: Classes, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many symbols agree before places a and b, and from a and b on. Levels are tried from the longest, each once."""
    n, back, ahead = len(classes.array), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for k in range(len(classes.at) - 1, -1, -1):
        step, at = 1 << k, classes.at[k]
        to = b + ahead
        same = (to < n) & (at[np.minimum(a + ahead, n - 1)] == at[np.minimum(to, n - 1)])
        ahead += step * same
        since = a - back - step
        same = (since >= 0) & (at[np.maximum(since, 0)] == at[np.maximum(b - back - step, 0)])
        back += step * same
    return back, ahead


def runs_of(symbols: np.ndarray) -> np.ndarray:
    """All runs of a line as rows of start, length and period, by start and period."""
    classes = suffix_classes(symbols)
    places, low, levels = [], [], []
    for k in range(FIRST_LEVEL, len(classes.at)):
        at, sizes = classes.at[k], classes.sizes[k]
        blocks = np.arange(0, len(symbols), 1 << k)
        blocks = blocks[sizes[at[blocks]] > 1]
        places.append(blocks)
        low.append(at[blocks])
        levels.append(np.full(len(blocks), k))
    if not places:
        return np.zeros((0, 3), np.int64)
    high = np.concatenate([begin + sizes[begin] for begin, sizes in zip(low, classes.sizes[FIRST_LEVEL:])])
    places, low, levels = np.concatenate(places), np.concatenate(low), np.concatenate(levels)
    before, after = neighbours(classes.array, low, high, places)
    a, b = np.concatenate([before, places]), np.concatenate([places, after])
    levels, period = np.tile(levels, 2), b - a
    near = np.flatnonzero((a >= 0) & (b >= 0) & (period <= 1 << levels) & ((2 * period > 1 << levels) | (levels == FIRST_LEVEL)))
    a, b, period = a[near], b[near], period[near]
    back, ahead = _agreement(classes, a, b)
    length = back + ahead + period
    found = np.stack([a - back, length, period], 1)[length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)]
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, a list of words; starts are word numbers of the text."""
    parts, taken = [], 0
    for words in texts:
        known: dict[bytes, int] = {}
        for word in words:
            parts.append(taken + known.setdefault(word, len(known)))
        taken += len(known) + 1
        parts.append(taken - 1)
    if not parts:
        return []
    starts = np.concatenate([[0], np.cumsum([len(words) + 1 for words in texts])])
    found = runs_of(np.array(parts, np.int64))
    cut = np.searchsorted(found[:, 0], starts)
    return [found[low:high] - [start, 0, 0] for low, high, start in zip(cut, cut[1:], starts)]


def greatest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; of equal ones the first, then that of the smallest period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def _groups(batches: Iterator[pa.RecordBatch], words_of) -> Iterator[tuple[pa.Array, list[list[bytes]]]]:
    """Ids and words of texts, in groups of about SLICE_WORDS."""
    ids, texts, size = [], [], 0
    for batch in batches:
        kind = batch.schema.field(0).type
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            words = words_of(doc_id, (text.as_py() or b"").split())  # splits at \\x20 and \\x09-\\x0D
            if size and size + len(words) > SLICE_WORDS:
                yield pa.array(ids, kind), texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(words)
            size += len(words) + 1
    if ids:
        yield pa.array(ids, kind), texts


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_of=lambda _, words: words) -> DataFrame:
    """Per row: doc_id, `n_words`, `runs` (start, length, period, by start and period), `best` of them, and the `collapsed` text.

    `words_of` may change the words that are looked at: it is given the id and the words of a text.
    """
    span = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _groups(batches, words_of):
            found = runs_of_texts(texts)
            flat = np.concatenate(found)
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])])
            runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(flat[:, c]) for c in range(3)], fields=list(span)))
            best = pa.array([dict(zip(("start", "length", "period"), b)) if b else None for b in map(greatest, found)], span)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(words) for words in texts], pa.int64()), runs, best,
                pa.array([collapsed(words, f).decode() for words, f in zip(texts, found)], pa.string())],
                names=["doc_id", "n_words", "runs", "best", "collapsed"])

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words bigint, runs array<struct<{SPAN}>>, best struct<{SPAN}>, collapsed string"
    return docs.select(doc_id, text).mapInArrow(work, schema)
