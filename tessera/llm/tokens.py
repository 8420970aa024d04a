"""Words of whole text columns as numpy arrays.

A batch of Arrow strings is one byte buffer with offsets.  Words, word hashes and
shingle hashes are computed on that buffer for all its documents at once; nothing is
done per word in Python.  Word characters are given as a set of separator bytes below
0x80, so every byte of a multi-byte character belongs to a word and working on UTF-8
bytes gives the same words as working on characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20          # a task holds about 60 times as much in arrays

ALNUM_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
SPACE_SEPARATORS = [0x20, *range(0x09, 0x0E)]

_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def word_table(separators) -> np.ndarray:
    """Which (lower-cased) bytes belong to words."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and the offsets of its rows."""
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(batches, text: str = "text", limit: int = CHUNK_BYTES):
    """Slices of the batches holding at most `limit` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = column_bytes(batch.column(batch.schema.names.index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


class Words:
    """The words of a column: `doc` (row), `start`, `end` (bytes), `hash`; `count` per row, `first` word of each row."""

    def __init__(self, col: pa.Array, table: np.ndarray, lower: bool = True):
        raw, off = column_bytes(col)
        data = _LOWER[raw] if lower else raw
        n = len(data)
        inside = table[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[off[:-1][off[:-1] < n]] = False
        after[off[1:][off[1:] > 0] - 1] = False
        self.data, self.offsets = data, off
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.first = self.first[:-1]
        self.doc = np.repeat(np.arange(len(off) - 1), self.count)
        up, down = _powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * up[:n], out=sums[1:])
        self.hash = mix64((sums[self.end] - sums[self.start]) * down[self.start])

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word index and hash of every run of n words inside a row."""
        if n <= 0 or len(self.hash) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(self.doc[: len(self.doc) - n + 1] == self.doc[n - 1:])
        return at, sequence_hash(self.hash, at, n)

    def words(self, a: int, b: int) -> str:
        """Words a to b - 1, with one space between."""
        return " ".join(self.data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(self.start[a:b], self.end[a:b]))


def sequence_hash(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    h = np.full(len(at), n, np.uint64)
    for k in range(n):
        h = mix64(h * np.uint64(_BASE) + hashes[at + k])
    return h


def signed(x: np.ndarray) -> pa.Array:
    """uint64 hashes as Spark longs."""
    return pa.array(x.view(np.int64))
