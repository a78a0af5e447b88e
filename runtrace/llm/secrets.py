"""Secret scans: fixed patterns, and Markov models of random strings against ordinary identifiers.

Patterns, leftmost and non-overlapping per kind, give the base spans. They also label the samples: characters of their
values train the model of random strings, all other runs of token characters the model of ordinary identifiers.
Both are first-order Markov chains over 68 token characters, counted over all documents, and smoothed by the symbols' own shares. A run of
`MIN_RUN` or more token characters that touches no base span is a secret of kind `markov` if its log-likelihood ratio is at least
`MIN_BITS` and `BITS_A_CHARACTER` for each character. Without any base span there is nothing to learn from and no such
span. Spans are in code points, end exclusive. Null texts are empty and have none; equal rows have equal spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtrace.llm.textbytes import Slice, byte_set, slices

# Kinds in their order, patterns, and the least length of each value.
KINDS = ("assign", "access", "hex", "markov")
_ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
#: The greedy run after AKIA, and a run of hexadecimal digits, are maximal: no shorter match hides a longer one.
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(rb"[0-9a-f]{16,}")
ASSIGN_VALUE = 12

MIN_RUN = 16
MIN_BITS = 24.0
BITS_A_CHARACTER = 1.5
#: Samples that a symbol's own share counts for, after each symbol.
SMOOTHING = 100.0

#: Bytes of text at once: a slice is held many times over, as symbols, pairs and their sums.
_BYTES = 250_000

_TOKEN = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_TOKEN[[ord(c) for c in "+/_.=-"]] = True
_SYMBOLS = int(_TOKEN.sum()) + 1
_OUTSIDE = _SYMBOLS - 1
_SYMBOL = np.full(256, _OUTSIDE, np.int32)
_SYMBOL[_TOKEN] = np.arange(_OUTSIDE)


def base_matches(text: bytes) -> list[tuple[int, int, int, int]]:
    """Kind, start and end of each match in bytes, and where its value starts."""
    found = []
    if b"=" in text or b":" in text:
        found += [(0, m.start(), m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if b"AKIA" in text:
        found += [(1, m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m.start()) for m in _HEX.finditer(text)]
    return found


def _matches(part: Slice) -> list[tuple[int, int, int, int, int]]:
    """Text, kind, start, end and value start of the matches of a slice, in bytes of the slice."""
    raw, found = part.bytes.tobytes(), []
    for i, (start, end) in enumerate(zip(part.starts.tolist(), part.ends.tolist())):
        for kind, a, b, v in base_matches(raw[start:end]):
            found.append((i, kind, start + a, start + b, start + v))
    return found


def _pairs(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each byte, and of the byte before it."""
    symbols = _SYMBOL[part.bytes]
    before = np.concatenate([[_OUTSIDE], symbols[:-1]]) if len(symbols) else symbols
    return symbols, before


def train(docs: DataFrame, text: str = "text") -> np.ndarray | None:
    """Bits for each pair of symbols that a random string is likelier than an identifier; None without samples."""
    cells = _SYMBOLS * _SYMBOLS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * cells, np.int64)
        for _, part in slices(batches, text, lower=False, size=_BYTES):
            symbols, before = _pairs(part)
            secret = np.zeros(len(symbols), bool)
            for _, _, _, end, value in _matches(part):
                secret[value:end] = True
            opens = secret & ~np.concatenate([[False], secret[:-1]])
            before = np.where(opens, _OUTSIDE, before)
            inside = symbols != _OUTSIDE
            total += np.bincount((before * _SYMBOLS + symbols + secret * cells)[inside], minlength=2 * cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    rows = docs.select(text).mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(2 * cells)
    counts[[r.cell for r in rows]] = [r.n for r in rows]
    ordinary, secret = counts.reshape(2, _SYMBOLS, _SYMBOLS)[:, :, :_OUTSIDE]
    if not secret.any():
        return None
    bits = np.zeros((_SYMBOLS, _SYMBOLS))
    bits[:, :_OUTSIDE] = np.log2(_chain(secret)) - np.log2(_chain(ordinary))
    return bits.ravel()


def _chain(counts: np.ndarray) -> np.ndarray:
    """Chances of the next symbol, each row smoothed by the symbols' own shares."""
    shares = counts.sum(0) + 0.5
    return (counts + SMOOTHING * shares / shares.sum()) / (counts.sum(1, keepdims=True) + SMOOTHING)


def _spans(part: Slice, bits: np.ndarray | None) -> list[list[tuple[int, int, int]]]:
    """Per text: start, kind and end of its spans in bytes of the slice, in order."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(part.n)]
    taken = np.zeros(len(part.bytes) + 1, np.int64)
    for i, kind, start, end, _ in _matches(part):
        out[i].append((start, kind, end))
        taken[start + 1:end + 1] = 1
    if bits is not None and len(part.bytes):
        starts, ends = part.runs(_TOKEN)
        long = ends - starts >= MIN_RUN
        starts, ends = starts[long], ends[long]
        symbols, before = _pairs(part)
        sums = np.concatenate([[0.0], np.cumsum(bits[before * _SYMBOLS + symbols])])
        used = np.cumsum(taken)
        ratio = sums[ends] - sums[starts]
        good = (ratio >= np.maximum(MIN_BITS, BITS_A_CHARACTER * (ends - starts))) & (used[ends] == used[starts])
        for i, start, end in zip(part.texts_of(starts[good]).tolist(), starts[good].tolist(), ends[good].tolist()):
            out[i].append((start, 3, end))
    for spans in out:
        spans.sort()
    return out


def _code_points(part: Slice, i: int, spans: list[tuple[int, int, int]]) -> list[dict]:
    begins = np.concatenate([[0], np.cumsum((part.bytes[part.starts[i]:part.ends[i]] & 0xC0) != 0x80)])
    first = part.starts[i]
    return [{"kind": KINDS[k], "start": int(begins[a - first]), "end": int(begins[b - first])} for a, k, b in spans]


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, bits: np.ndarray | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and its spans by start, then kind."""

    def work(batches):
        for batch, part in slices(batches, "text", lower=False, size=_BYTES):
            found = [_code_points(part, i, s) if s else [] for i, s in enumerate(_spans(part, bits))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], names=["key", "spans"])

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(work, f"key {kind}, spans {SPANS}").withColumnRenamed("key", key)


def redact(docs: DataFrame, bits: np.ndarray | None, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, with `[kind]` in place of each secret; overlapping spans become one, named by the first.

    `length` names a column that holds the number of code points of the text; it is set anew where a text changed.
    """
    columns = docs.columns

    def work(batches):
        for batch, part in slices(batches, text, lower=False, size=_BYTES):
            changed = {}
            raw = part.bytes.tobytes()
            for i, spans in enumerate(_spans(part, bits)):
                if not spans:
                    continue
                pieces, at = [], int(part.starts[i])
                for start, kind, end in spans:
                    if start >= at:
                        pieces += [raw[at:start], f"[{KINDS[kind]}]".encode()]
                    at = max(at, end)
                changed[i] = b"".join([*pieces, raw[at:part.ends[i]]]).decode("utf-8", "replace")
            if changed:
                place = columns.index(text)
                texts = batch.column(place).to_pylist()
                for i, t in changed.items():
                    texts[i] = t
                batch = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.column(place).type))
                if length in columns:
                    place = columns.index(length)
                    sizes = batch.column(place).to_pylist()
                    for i, t in changed.items():
                        sizes[i] = len(t)
                    batch = batch.set_column(place, batch.schema.field(place), pa.array(sizes, batch.column(place).type))
            yield batch

    return docs.mapInArrow(work, docs.schema)
