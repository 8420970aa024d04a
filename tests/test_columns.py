"""Column chunks: exact round trip, dense where they should be, hot features in many chunks."""

import numpy as np
import pytest

from tessera.operators import columns as CO


@pytest.mark.parametrize("chunk", [7, 64, 1 << 15])
def test_round_trip(spark, chunk):
    rng = np.random.default_rng(chunk)
    X = rng.integers(-128, 128, (300, 9)) * (rng.random((300, 9)) < np.linspace(0.0, 1.0, 9))
    entries = [(int(k), int(i), int(X[i, k])) for i, k in zip(*np.nonzero(X))]
    df = spark.createDataFrame(entries, "k int, id long, v int").repartition(4)
    chunks = CO.column_chunks(df, 300, chunk)
    rows = chunks.collect()
    for r in rows:
        part = X[r.chunk * chunk:(r.chunk + 1) * chunk, r.k]
        assert r.size == len(part) and (r.positions is None) == ((part != 0).sum() >= 0.5 * len(part))
        column = np.zeros(r.size, int)
        column[r.positions if r.positions is not None else slice(None)] = r.vals
        assert (column == part).all()
    assert sorted(tuple(r) for r in CO.column_entries(chunks, chunk).collect()) == sorted(entries)
    assert len([r for r in rows if r.k == 8]) == -(-300 // chunk)


def test_no_entries(spark):
    df = spark.createDataFrame([], "k int, id long, v int")
    assert CO.column_chunks(df, 10).count() == 0 and CO.column_entries(CO.column_chunks(df, 10)).count() == 0
