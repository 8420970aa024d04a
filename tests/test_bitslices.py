"""Bit-sliced counting and lazy selection against the exploded form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import bitslices as B
from tessera.operators import infotheory as I
from tessera.operators import selection as S


def frame(spark, X, y, parts=3):
    rows = [([int(v) for v in x], int(c)) for x, c in zip(X, y)]
    return spark.createDataFrame(rows, "x array<tinyint>, y tinyint").repartition(parts)


def cells(df):
    return sorted(tuple(r) for r in df.select("j", "k", "v", "z", "y", "c").collect())


@pytest.mark.parametrize("levels, rows", [(3, 700), (256, 700), (5, 1), (2, 65)])
def test_cells_equal_the_exploded_ones(spark, monkeypatch, levels, rows):
    rng = np.random.default_rng(levels)
    X = rng.integers(-128, -128 + levels, (rows, 6)) if levels > 100 else rng.integers(-2, levels - 2, (rows, 6))
    df = frame(spark, X, rng.integers(-1, 3, rows))
    assert cells(B.cells(B.bit_slices(df), [0, 4])) == cells(I.dense_cells_many(df, [0, 4]))
    assert cells(B.cells(B.bit_slices(df), [2], only=[1, 5])) == cells(I.dense_cells_many(df, [2], only=[1, 5]))
    alone = I.dense_cells(df).withColumn("j", F.lit(0))
    assert cells(B.cells(B.bit_slices(df), [None])) == cells(alone)


def test_no_rows(spark):
    df = spark.createDataFrame([], "x array<tinyint>, y tinyint")
    assert B.cells(B.bit_slices(df), [None]).count() == 0


def related(seed, n=400, d=24):
    """Features of which several repeat one another, so that many never come near winning."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 3, n)
    X = np.column_stack([np.where(rng.random(n) < 0.1 + 0.8 * (k % 8) / 8, rng.integers(0, 4, n), (y + k // 8) % 4) for k in range(d)])
    return X, y


@pytest.mark.parametrize("criterion", S.LAZY_CRITERIA)
@pytest.mark.parametrize("source", [S.DenseFeatures, S.BitSlicedFeatures])
def test_lazy_picks_are_the_greedy_ones(spark, criterion, source):
    X, y = related(3)
    src = source(frame(spark, X, y))
    try:
        want = S.greedy_select(src, criterion, 5)
        got = S.lazy_select(src, criterion, 5, batch=4)
    finally:
        src.release()
    assert got.features == want.features and np.allclose(got.scores, want.scores, atol=1e-12)
    assert 0 < got.evaluated < got.eager


def test_bit_sliced_selection_is_the_same(spark):
    X, y = related(4)
    dense, bits = S.DenseFeatures(frame(spark, X, y)), S.BitSlicedFeatures(frame(spark, X, y))
    try:
        assert S.greedy_select_many(bits, ["mrmr", "jmi", "mifs"], 4) == S.greedy_select_many(dense, ["mrmr", "jmi", "mifs"], 4)
    finally:
        dense.release(), bits.release()


def test_other_criteria_are_refused(spark):
    src = S.DenseFeatures(frame(spark, *related(1, 30, 4)))
    with pytest.raises(ValueError):
        S.lazy_select(src, "jmi", 2)
    src.release()
