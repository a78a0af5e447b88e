"""Words of many texts at once: UTF-8 bytes of a slice of rows, with numpy instead of a loop over words.

A slice is a list of whole texts of about `SLICE_BYTES`; one longer text is a slice of its own. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_000_000
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 2**64))
_BYTE_KEYS = np.random.default_rng(20_231).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {}


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true in the given closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Bytes of words: all but space and \t \n \v \f \r; and all but ASCII that is neither a digit nor a letter.
UNSPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i up to n."""
    if _powers.get("n", 0) < n + 1:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        for name, base in (("up", _P), ("down", _P_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Slice:
    """Bytes of some texts, each followed by one line feed, so that no word spans two texts."""

    def __init__(self, texts: list[bytes | None], lower: bool = True):
        parts = [t or b"" for t in texts]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        raw = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        self.bytes = LOWER[raw] if lower else raw
        self.n = len(parts)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        self._sums = None

    def runs(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of the bytes in a table."""
        inside = table[self.bytes]
        inside[self.ends] = False  # the line feeds between texts
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        return edges[::2], edges[1::2]

    def texts_of(self, places: np.ndarray) -> np.ndarray:
        """The text that each place is in."""
        return np.searchsorted(self.ends, places, side="left")

    def per_text(self, owners: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owners, weights, minlength=self.n)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes between starts and ends, equal for equal bytes anywhere."""
        up, down = powers(len(self.bytes))
        if self._sums is None:
            self._sums = np.zeros(len(self.bytes) + 1, np.uint64)
            np.cumsum(_BYTE_KEYS[self.bytes] * up[: len(self.bytes)], out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def code_points(self) -> np.ndarray:
        """For each byte place, how many code points of its text begin before it."""
        begins = (self.bytes & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(begins)])
        return before


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of sequences, from the hashes of their members in order."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + part)
    return out


def windows(hashes: np.ndarray, owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, owner and first word of every run of `length` words of one text."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = np.flatnonzero(owners[: len(owners) - length + 1] == owners[length - 1:])
    return chain([hashes[whole + k] for k in range(length)]), owners[whole], whole


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", lower: bool = True,
           size: int = SLICE_BYTES, most: int | None = None) -> Iterator[tuple[pa.RecordBatch, Slice]]:
    """The rows of Arrow batches in slices, each with the words of its texts; of `most` texts at most."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        lengths = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]) if len(column) else []
        first, total = 0, 0
        for i, length in enumerate(lengths):
            if total and total + length > size or i - first == most:
                yield batch.slice(first, i - first), Slice(column.slice(first, i - first).to_pylist(), lower)
                first, total = i, 0
            total += int(length)
        if first < len(column):
            yield batch.slice(first), Slice(column.slice(first).to_pylist(), lower)
        del column, lengths
        pa.default_memory_pool().release_unused()
