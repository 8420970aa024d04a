"""Contingency cells from bit-sliced columns.

A chunk of rows becomes one row: for every feature (and the label) and every value it takes
in the chunk, a bitmap of the chunk's rows.  A cell's count is the number of bits of the AND of
three bitmaps, value of the feature, value of the reference feature and label, so a round of
selection ANDs words instead of exploding every row over its features again.  Bitmaps that
are empty are not stored, and chunks shrink as rows widen, so a chunk is a few megabytes.

Where features take so many values that the ANDs would cost more than the rows themselves, a
chunk's columns are read back from their bitmaps and counted by value; both ways are exact.
A task adds up the cells of all its chunks before they are shuffled, as partial aggregation does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CELLS = 1 << 22        # rows x features of a chunk
MAX_CHUNK = 1 << 16
_LABEL = -1
_SLICES = "n int, ks array<int>, vs array<int>, bits binary"
_CELLS = "j int, k int, v tinyint, z tinyint, y tinyint, c bigint"
_MERGE = 1 << 20
_AND_COST = 4                # word ANDs that cost as much as counting one value of one row


def _bitmaps(column: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    values = np.unique(column)
    out = np.zeros((len(values), words * 8), np.uint8)
    packed = np.packbits(column[None, :] == values[:, None], axis=1, bitorder="little")
    out[:, :packed.shape[1]] = packed
    return values, out


def _slice(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        off = x.offsets.to_numpy()
        flat = x.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].reshape(batch.num_rows, -1)
        step = max(64, min(MAX_CHUNK, CHUNK_CELLS // max(flat.shape[1], 1)))
        for at in range(0, batch.num_rows, step):
            part, label = flat[at:at + step], y[at:at + step]
            words = -(-len(label) // 64)
            ks, vs, bits = [], [], []
            for k in range(_LABEL, part.shape[1]):
                values, maps = _bitmaps(label if k == _LABEL else part[:, k], words)
                ks += [k] * len(values)
                vs += values.tolist()
                bits.append(maps.tobytes())
            yield pa.record_batch({"n": pa.array([len(label)], pa.int32()), "ks": pa.array([ks], pa.list_(pa.int32())),
                                   "vs": pa.array([vs], pa.list_(pa.int32())), "bits": pa.array([b"".join(bits)], pa.binary())})


def bit_slices(rows: DataFrame) -> DataFrame:
    """(n, ks, vs, bits): a row per chunk of the rows (x array<tinyint>, y tinyint); feature -1 is the label."""
    return rows.select("x", "y").mapInArrow(_slice, _SLICES)


def _column(values: np.ndarray, maps: np.ndarray, n: int) -> np.ndarray:
    """A chunk's column from its bitmaps."""
    out = np.empty(n, np.int64)
    for v, m in zip(values, maps):
        out[np.unpackbits(m.view(np.uint8), count=n, bitorder="little").astype(bool)] = v
    return out


class _Chunk:
    def __init__(self, row: dict):
        self.n = row["n"]
        self.ks, self.vs = np.array(row["ks"], np.int64), np.array(row["vs"], np.int64)
        self.maps = np.frombuffer(row["bits"], np.uint64).reshape(len(self.ks), -1)

    def of(self, k: int):
        a, b = np.searchsorted(self.ks, [k, k + 1])
        return self.vs[a:b], self.maps[a:b]

    def cells(self, given: int | None, only: np.ndarray | None):
        """(k, v, z, y, count) of the cells that occur, against the feature `given` (none: z = 0)."""
        labels, label_maps = self.of(_LABEL)
        refs, ref_maps = (np.zeros(1, np.int64), np.full((1, self.maps.shape[1]), ~np.uint64(0))) if given is None else self.of(given)
        rows = np.flatnonzero(self.ks >= 0 if only is None else np.isin(self.ks, only))
        if len(rows) * len(refs) * len(labels) * self.maps.shape[1] > _AND_COST * self.n * len(np.unique(self.ks[rows])):
            return self._by_value(rows, refs, ref_maps, labels, label_maps, given)
        out = []
        for z, zm in zip(refs, ref_maps):
            for y, ym in zip(labels, label_maps):
                both = zm & ym
                if both.any():
                    c = np.bitwise_count(self.maps[rows] & both).sum(axis=1, dtype=np.int64)
                    hit = np.flatnonzero(c)
                    out.append((self.ks[rows[hit]], self.vs[rows[hit]], np.full(len(hit), z), np.full(len(hit), y), c[hit]))
        return [np.concatenate(x) for x in zip(*out)]

    def _by_value(self, rows, refs, ref_maps, labels, label_maps, given):
        pair = _column(labels, label_maps, self.n) + 128
        if given is not None:
            pair = pair + ((_column(refs, ref_maps, self.n) + 128) << 8)
        out = []
        for k in np.unique(self.ks[rows]):
            code, c = np.unique(((_column(*self.of(k), self.n) + 128) << 16) + pair, return_counts=True)
            z = (code >> 8 & 255) - 128 if given is not None else np.zeros(len(code), np.int64)
            out.append((np.full(len(code), k), (code >> 16) - 128, z, (code & 255) - 128, c))
        return [np.concatenate(x) for x in zip(*out)]


def _counted(given: list[int | None], only: list[int] | None):
    def run(batches):
        some = None if only is None else np.array(only, np.int64)
        keys, counts, held = [], [], 0

        def merged():
            code, place = np.unique(np.concatenate(keys), return_inverse=True)
            return code, np.bincount(place, np.concatenate(counts).astype(np.float64)).astype(np.int64)

        for batch in batches:
            for k in range(batch.num_rows):
                chunk = _Chunk(batch.slice(k, 1).to_pylist()[0])
                for at, j in enumerate(given):
                    cells = chunk.cells(j, some)
                    if cells:
                        f, v, z, y, c = cells
                        keys.append((((((at << 31 | f) << 8 | v + 128) << 8) | z + 128) << 8) | y + 128)
                        counts.append(c)
                        held += len(c)
                if held > _MERGE:
                    code, c = merged()
                    keys, counts, held = [code], [c], 0
        if keys:
            code, c = merged()
            name = np.array([0 if j is None else j for j in given])
            small = lambda x: pa.array((x & 255) - 128).cast(pa.int8())
            yield pa.record_batch({"j": pa.array(name[code >> 55]).cast(pa.int32()), "k": pa.array(code >> 24 & 0x7FFFFFFF).cast(pa.int32()),
                                   "v": small(code >> 16), "z": small(code >> 8), "y": small(code), "c": pa.array(c)})
    return run


def cells(slices: DataFrame, given: list[int | None], only: list[int] | None = None) -> DataFrame:
    """Cells (j, k, v, z, y, c) of every feature, or those of ``only``, against each feature in ``given`` in one pass."""
    if len(given) > 256:
        raise ValueError("at most 256 reference features in one pass")
    parts = slices.mapInArrow(_counted(list(given), only), _CELLS)
    return parts.groupBy("j", "k", "v", "z", "y").agg(F.expr("sum(c) AS c"))
