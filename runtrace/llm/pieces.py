"""SentencePiece encoding and decoding with N-best segmentation.

A text gets one space in front; a space is the piece character for a word's start. Pieces may cover any stretch of it that is in
the vocabulary; a character that is no piece becomes its UTF-8 bytes as byte pieces. So decoding gives exactly the text back,
also for texts that hold the piece character U+2581 itself. Scores are whole millionths: of the model's log
probabilities, or, where the model has merge ranks instead, of -ln(2 + rank) (Zipf's law). Whole numbers make equal
sums equal.

No piece has a word's start after another character, so the lattice of a text falls apart into units: a run of spaces
with what follows it, and single line feeds. Forward Viterbi scores of all distinct units of a slice are found at once;
backward ones give, for each unit, the gap between its best and its second segmentation. A list of the N best segmentations of a whole
text differs from the best only in the N - 1 occurrences with the smallest gaps: changing any other costs at least as much as
each of N - 1 single changes. The backward A* search runs over the lattice in which all other units are single edges,
with the forward Viterbi scores as exact heuristic: it never expands a path that is not among the N best.

The ids of a text are those of the first path that the search finds, the alternatives those of the next ones. Paths of equal scores come
in the order in which the search meets them, the same in every run; gaps that are equal are taken from the left.
A null text has no pieces (null ids and scores); an empty text has the pieces of a single space. Repeated rows are encoded alike.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from runtrace.llm.textbytes import Slice, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MICRO = 1_000_000
#: Units up to so many bytes are segmented together, longer ones each by itself.
SHORT = 64
_NEVER = -(1 << 60)
#: A slice of more than 2^20 bytes takes twice the powers for its hashes, which stay in the worker.
_SLICE = 1_000_000
#: Units whose segmentation a worker keeps.
UNITS_KEPT = 250_000
#: Lattices that a worker keeps.
LATTICES_KEPT = 3_000


@dataclass
class Vocabulary:
    """Pieces as bytes, with a space for the piece character; a score for each; ids of the 256 byte pieces."""

    pieces: list[bytes]
    scores: np.ndarray
    usable: np.ndarray
    byte_ids: np.ndarray
    byte_score: int
    _tables: dict = field(default_factory=dict, repr=False)

    def tables(self) -> dict:
        """Hash table of the usable pieces; made once in each worker."""
        if not self._tables:
            ids = np.flatnonzero(self.usable)
            joined = [self.pieces[i] for i in ids]
            part = Slice(joined, lower=False)
            hashes = part.hashes(part.starts, part.ends)
            order = np.argsort(hashes)
            there = np.zeros(1 << 20, bool)
            there[hashes >> np.uint64(44)] = True
            self._tables.update(
                hashes=hashes[order], ids=ids[order], there=there, lengths=sorted({len(p) for p in joined}),
                by_bytes={self.pieces[i]: int(i) for i in ids}, score_list=self.scores.tolist())
        return self._tables

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are of pieces, and the pieces' ids."""
        t = self.tables()
        maybe = np.flatnonzero(t["there"][hashes >> np.uint64(44)])
        place = np.searchsorted(t["hashes"], hashes[maybe])
        place[place == len(t["hashes"])] = 0
        same = t["hashes"][place] == hashes[maybe]
        return maybe[same], t["ids"][place[same]]


def load(path: str = MODEL) -> Vocabulary:
    """Read a model file on the driver; the vocabulary is small and fixed, and travels with the tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    texts = [model.id_to_piece(i) for i in range(n)]
    raw = np.array([model.get_score(i) for i in range(n)])
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)]
    usable = ~np.array(special)
    if not all(model.is_byte(int(i)) for i in byte_ids):
        raise ValueError("the model has no byte pieces")
    if any("▁" in t[1:] and t.strip("▁") for t, ok in zip(texts, usable) if ok):
        raise ValueError("a piece spans words")
    if any(" " in t or "\n" in t for t, ok in zip(texts, usable) if ok):
        raise ValueError("a piece holds white space")
    ranked = np.all(raw[usable] == np.round(raw[usable])) and raw[usable].min() < -1000
    logs = -np.log(2 - raw) if ranked else raw
    scores = np.round(logs * MICRO).astype(np.int64)
    scores[~usable] = 0
    return Vocabulary([t.replace("▁", " ").encode() for t in texts], scores, usable, byte_ids,
                      int(round((min(-math.log(n), logs[usable & (raw > -1e8)].min()) - 2) * MICRO)))


class Lattice:
    """Nodes 0..n and edges (start, score, ids) by end, in order of preference among equals."""

    def __init__(self, n: int):
        self.into: list[list[tuple[int, int, tuple]]] = [[] for _ in range(n + 1)]

    def forward(self) -> list[int]:
        best = [0] + [_NEVER] * (len(self.into) - 1)
        for end in range(1, len(self.into)):
            for start, score, _ in self.into[end]:
                if best[start] > _NEVER and best[start] + score > best[end]:
                    best[end] = best[start] + score
        return best

    def backward(self) -> list[int]:
        best = [_NEVER] * (len(self.into) - 1) + [0]
        for end in range(len(self.into) - 1, 0, -1):
            if best[end] > _NEVER:
                for start, score, _ in self.into[end]:
                    best[start] = max(best[start], best[end] + score)
        return best

    def n_best(self, n: int) -> list[tuple[int, list]]:
        """The n best paths and their scores: A* from the last node, with forward scores as heuristic."""
        ahead, found, made = self.forward(), [], 0
        heap = [(-ahead[-1], 0, len(self.into) - 1, 0, None)] if ahead[-1] > _NEVER else []
        while heap and len(found) < n:
            estimate, _, node, behind, path = heapq.heappop(heap)
            if node == 0:
                ids = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                found.append((-estimate, ids))
                continue
            for start, score, ids in self.into[node]:
                if ahead[start] > _NEVER:
                    made += 1
                    heapq.heappush(heap, (-(ahead[start] + score + behind), made, start, behind + score, (ids, path)))
        return found


def unit_lattice(unit: bytes, words: Vocabulary) -> Lattice:
    """All pieces of one unit."""
    t = words.tables()
    known, scores = t["by_bytes"], t["score_list"]
    lattice = Lattice(len(unit))
    begins = [i for i, b in enumerate(unit) if (b & 0xC0) != 0x80] + [len(unit)]
    for start, after in zip(begins, begins[1:]):
        fallback = True
        for n in t["lengths"]:
            end = start + n
            if end > len(unit):
                break
            piece = known.get(unit[start:end])
            if piece is not None:
                lattice.into[end].append((start, scores[piece], (piece,)))
                fallback &= end != after
        if fallback:
            ids = tuple(int(words.byte_ids[b]) for b in unit[start:after])
            lattice.into[after].append((start, words.byte_score * len(ids), ids))
    for edges in lattice.into:
        edges.sort(key=lambda e: e[0])
    return lattice


def _segment_long(unit: bytes, words: Vocabulary) -> tuple[list[int], int, int]:
    """Best ids, their score, and the gap to the second segmentation."""
    lattice = unit_lattice(unit, words)
    best, back = lattice.forward(), lattice.backward()
    node, ids, gap, path = len(unit), [], -_NEVER, set()
    while node:
        edge = next(e for e in lattice.into[node] if best[e[0]] > _NEVER and best[e[0]] + e[1] == best[node])
        path.add((edge[0], node))
        ids.append(edge[2])
        node = edge[0]
    for end, edges in enumerate(lattice.into):
        for start, score, _ in edges:
            if (start, end) not in path and best[start] > _NEVER and back[end] > _NEVER:
                gap = min(gap, best[-1] - (best[start] + score + back[end]))
    return [i for part in reversed(ids) for i in part], best[-1], gap


def _segment_short(part: Slice, starts: np.ndarray, sizes: np.ndarray, words: Vocabulary):
    """The same for many units of at most SHORT bytes: ids and their counts, scores, gaps."""
    m, width = len(starts), int(sizes.max())
    lengths = [n for n in words.tables()["lengths"] if n <= width]
    forward = np.full((m, width + 1), _NEVER, np.int64)
    forward[:, 0] = 0
    came, piece = np.zeros((m, width + 1), np.int16), np.full((m, width + 1), -1, np.int32)
    edges = []
    begins = (part.bytes & 0xC0) != 0x80
    follows = np.concatenate([begins[1:], [True]])  # the next byte begins a character
    open_start = np.zeros((m, width + 1), np.int16)  # where the character that ends here starts
    for end in range(1, width + 1):
        active = np.flatnonzero(sizes >= end)
        at = starts[active] + end
        first = begins[at - 1]
        open_start[active, end] = np.where(first, end - 1, open_start[active, end - 1])
        whole = follows[at - 1]
        active, at = active[whole], at[whole]
        single = open_start[active, end]
        plain = np.zeros(len(active), bool)
        for n in reversed([n for n in lengths if n <= end]):
            usable = np.flatnonzero(begins[at - n])
            where, ids = words.find(part.hashes(at[usable] - n, at[usable]))
            where = usable[where]
            plain[where[single[where] == end - n]] = True
            rows = active[where]
            reach = forward[rows, end - n]
            score = reach + words.scores[ids]
            live = reach > _NEVER
            rows, ids, score = rows[live], ids[live], score[live]
            edges.append((rows, np.full(len(rows), end - n, np.int16), np.full(len(rows), end, np.int16), ids))
            better = score > forward[rows, end]
            forward[rows[better], end] = score[better]
            came[rows[better], end], piece[rows[better], end] = end - n, ids[better]
        bare = np.flatnonzero(~plain)
        rows, from_ = active[bare], single[bare]
        reach = forward[rows, from_]
        live = reach > _NEVER
        rows, from_, reach = rows[live], from_[live], reach[live]
        score = reach + words.byte_score * (end - from_).astype(np.int64)
        edges.append((rows, from_, np.full(len(rows), end, np.int16), np.full(len(rows), -1, np.int64)))
        better = score > forward[rows, end]
        forward[rows[better], end] = score[better]
        came[rows[better], end], piece[rows[better], end] = from_[better], -1
    every = np.arange(m)
    best = forward[every, sizes]
    # Backward scores; edges in order of falling end, so each end is settled before it is used.
    backward = np.full((m, width + 1), _NEVER, np.int64)
    backward[every, sizes] = 0
    gaps = np.full(m, -_NEVER, np.int64)
    chosen = np.zeros((m, width + 1), bool)  # ends on the best path
    node = sizes.copy()
    steps = []
    while len(live := np.flatnonzero(node > 0)):
        chosen[live, node[live]] = True
        steps.append((live, came[live, node[live]].copy(), node[live].copy(), piece[live, node[live]].copy()))
        node[live] = came[live, node[live]]
    for rows, start, end, ids in reversed(edges):
        score = np.where(ids >= 0, words.scores[ids], words.byte_score * (end - start).astype(np.int64))
        back = backward[rows, end]
        live = back > _NEVER
        rows, start, end, score, back = rows[live], start[live], end[live], score[live], back[live]
        backward[rows, start] = np.maximum(backward[rows, start], back + score)
        other = ~(chosen[rows, end] & (came[rows, end] == start))
        through = forward[rows[other], start[other]] + score[other] + back[other]
        gaps[rows[other]] = np.minimum(gaps[rows[other]], best[rows[other]] - through)
    unit, start, end, ids = (np.concatenate(x) for x in zip(*steps))
    return _in_order(part, starts, unit, start, end, ids, m, words), best, gaps


def _in_order(part: Slice, starts, unit, start, end, ids, m, words) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all best paths by unit and place, byte pieces spelt out: ids, and how many each unit has."""
    count = np.where(ids >= 0, 1, end - start).astype(np.int64)
    order = np.lexsort((start, unit))
    unit, start, ids, count = unit[order], start[order].astype(np.int64), ids[order], count[order]
    row = np.repeat(np.arange(len(unit)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    spelt = words.byte_ids[part.bytes[np.minimum(starts[unit[row]] + start[row] + step, len(part.bytes) - 1)]]
    return np.where(ids[row] >= 0, ids[row], spelt).astype(np.int32), np.bincount(unit, count, minlength=m).astype(np.int64)


class Units:
    """Segmentations of units by their hash, kept from slice to slice of a worker and emptied when they are too many."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.offsets, self.counts, self.best, self.gaps = (np.zeros(0, np.int64) for _ in range(4))
        self.ids = np.zeros(0, np.int32)
        self.lattices: dict[int, Lattice] = {}

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        return place, self.hashes[place] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)

    def learn(self, part: Slice, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """Segment units that are not kept yet."""
        offsets, counts, best, gaps = (np.zeros(len(hashes), np.int64) for _ in range(4))
        chunks, total = [self.ids], len(self.ids)
        order = np.argsort(sizes, kind="stable")
        short = order[: np.searchsorted(sizes[order], SHORT, side="right")]
        for block in np.array_split(short, max(1, -(-len(short) // 10_000))):
            if len(block):
                (found, n), best[block], gaps[block] = _segment_short(part, starts[block], sizes[block], self.words)
                counts[block], offsets[block] = n, total + np.cumsum(n) - n
                chunks.append(found)
                total += len(found)
        for u in order[len(short):].tolist():
            found, best[u], gaps[u] = _segment_long(part.bytes[starts[u]:starts[u] + sizes[u]].tobytes(), self.words)
            counts[u], offsets[u] = len(found), total
            chunks.append(np.array(found, np.int32))
            total += len(found)
        self.ids = np.concatenate(chunks)
        merged = np.concatenate([self.hashes, hashes])
        order = np.argsort(merged, kind="stable")
        self.hashes = merged[order]
        for name, more in (("offsets", offsets), ("counts", counts), ("best", best), ("gaps", gaps)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order])


@dataclass
class Encoded:
    """Ids of a slice's texts one after another, where each text's begin, best scores, and the N best of each text.

    A path of the N best is a list of ids and of slices of `ids`.
    """

    ids: np.ndarray
    places: np.ndarray
    scores: np.ndarray
    n_best: list[list[tuple[int, list]]]

    def path_ids(self, path: list) -> np.ndarray:
        return np.concatenate([self.ids[x] if isinstance(x, slice) else np.array([x], np.int32) for x in path])


def encode_slice(texts: list[bytes], words: Vocabulary, n: int, units: Units | None = None) -> Encoded:
    units = units or Units(words)
    if len(units.hashes) > UNITS_KEPT:
        units.clear()
    if len(units.lattices) > LATTICES_KEPT:
        units.lattices.clear()
    part = Slice([b" " + t for t in texts], lower=False)
    data = part.bytes
    space, feed = data == 0x20, data == 0x0A
    cut = feed | np.concatenate([[True], feed[:-1]]) | (space & ~np.concatenate([[False], space[:-1]]))
    cut[part.ends] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    real = np.ones(len(starts), bool)
    real[np.searchsorted(starts, part.ends)] = False  # the feeds that Slice adds
    starts, ends = starts[real], ends[real]
    hashes, first, unit = np.unique(part.hashes(starts, ends), return_index=True, return_inverse=True)
    fresh = ~units.places(hashes)[1]
    units.learn(part, hashes[fresh], starts[first][fresh], (ends - starts)[first][fresh])
    place = units.places(hashes)[0]
    unit = place[unit]
    n_ids = units.counts[unit]
    bounds = np.concatenate([[0], np.cumsum(n_ids)])
    flat = units.ids[np.repeat(units.offsets[unit] - bounds[:-1], n_ids) + np.arange(bounds[-1])]
    first_unit = np.concatenate([[0], np.searchsorted(starts, part.ends)])
    sums = np.concatenate([[0], np.cumsum(units.best[unit])])
    result = Encoded(flat, bounds[first_unit], sums[first_unit[1:]] - sums[first_unit[:-1]], [])
    gaps = units.gaps[unit]
    for a, b in zip(first_unit[:-1].tolist(), first_unit[1:].tolist()):
        gap = gaps[a:b]
        limit = np.partition(gap, n - 2)[n - 2] if len(gap) > n - 1 > 0 else -_NEVER
        near = np.concatenate([np.flatnonzero(gap < limit), np.flatnonzero(gap == limit)])[: n - 1]
        near = np.sort(near[gap[near] < -_NEVER]) + a
        spans, at = [], a
        for u in near.tolist():
            lattice = units.lattices.get(hash_ := int(units.hashes[unit[u]]))
            if lattice is None:
                lattice = units.lattices[hash_] = unit_lattice(data[starts[u]:ends[u]].tobytes(), words)
            spans += [(at, u, None)] * (u > at) + [(u, u + 1, lattice)]
            at = u + 1
        spans += [(at, b, None)] * (b > at)
        result.n_best.append(_text_n_best(spans, n, sums, bounds))
    return result


def _text_n_best(spans, n: int, sums: np.ndarray, bounds: np.ndarray) -> list[tuple[int, list]]:
    """N best segmentations of a text, given as runs of settled units and single units with all their pieces."""
    whole = Lattice(sum(1 if free is None else len(free.into) - 1 for _, _, free in spans))
    base = 0
    for start, end, free in spans:
        if free is None:
            whole.into[base + 1].append((base, int(sums[end] - sums[start]), (slice(int(bounds[start]), int(bounds[end])),)))
            base += 1
        else:
            for node, edges in enumerate(free.into):
                whole.into[base + node] += [(base + s, score, ids) for s, score, ids in edges]
            base += len(free.into) - 1
    return whole.n_best(n)


def decode(ids, words: Vocabulary) -> bytes:
    """The text of pieces; the space in front goes."""
    flat, begins = words.tables().get("spelt") or _spelt(words)
    ids = np.asarray(ids, np.int64)
    sizes = begins[ids + 1] - begins[ids]
    ends = np.cumsum(sizes)
    return flat[np.repeat(begins[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()[1:]


def _spelt(words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all pieces one after another, and where each begins."""
    spelt = list(words.pieces)
    for value, i in enumerate(words.byte_ids.tolist()):
        spelt[i] = bytes([value])
    made = np.frombuffer(b"".join(spelt), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in spelt])])
    words.tables()["spelt"] = made
    return made


def encode(docs: DataFrame, words: Vocabulary, key: str = "doc_id", text: str = "text", n: int = 3, with_ids: bool = True) -> DataFrame:
    """Per row: key, n_pieces, ids, ids_sha256 (little-endian int32), score, n_best, round_trip.

    `n_best` holds the n best segmentations with their scores, ids and digests, best first; the first is the one in `ids`.
    `round_trip` says whether decoding each of them gives the text. Without `with_ids` ids are null, digests are not.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)
    best = pa.struct([("score", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32())), ("ids_sha256", pa.string())])
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.string(), pa.int64(), pa.list_(best), pa.bool_()]
    names = ["n_pieces", "ids", "ids_sha256", "score", "n_best", "round_trip"]

    def work(batches):
        words = shared.value
        units = words.tables().setdefault("units", Units(words))
        for batch, part in slices(batches, "text", lower=False, size=_SLICE):
            raw, null = part.bytes.tobytes(), batch.column(1).is_null().to_pylist()
            texts = [raw[a:b] for a, b in zip(part.starts.tolist(), part.ends.tolist())]
            done = encode_slice(texts, words, n, units)
            rows = []
            for i, t in enumerate(texts):
                if null[i]:
                    rows.append((0, None, None, None, None, None))
                    continue
                found, same = [], True
                for score, path in done.n_best[i]:
                    ids = done.path_ids(path)
                    same = same and decode(ids, words) == t
                    found.append({"score": score, "n_pieces": len(ids), "ids": ids if with_ids else None,
                                  "ids_sha256": hashlib.sha256(ids.tobytes()).hexdigest()})
                rows.append((found[0]["n_pieces"], found[0]["ids"], found[0]["ids_sha256"], found[0]["score"], found, same))
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["key", *names])

    kind = docs.schema[key].dataType.simpleString()
    schema = (f"key {kind}, n_pieces bigint, ids array<int>, ids_sha256 string, score bigint, "
              "n_best array<struct<score: bigint, n_pieces: bigint, ids: array<int>, ids_sha256: string>>, round_trip boolean")
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return rows.mapInArrow(work, schema).withColumnRenamed("key", key)
