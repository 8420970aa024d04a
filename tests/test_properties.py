"""Property tests on random small matrices (hypothesis, few examples: each is a Spark job)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import infotheory as I
from tests.test_infotheory import cmi, entropy, frame, mi

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@st.composite
def matrices(draw):
    n = draw(st.integers(20, 80))
    d = draw(st.integers(2, 4))
    levels = draw(st.integers(2, 5))
    seed = draw(st.integers(0, 10_000))
    rng = np.random.default_rng(seed)
    return rng.integers(-levels, levels, (n, d)), rng.integers(0, 3, n)


@SETTINGS
@given(matrices())
def test_measures_match_entropy_definitions(spark, m):
    X, y = m
    df = frame(spark, X, y)
    info = {r["k"]: r for r in I.information(I.dense_cells(df, given=0)).collect()}
    for k in range(X.shape[1]):
        assert info[k]["rel"] == pytest.approx(mi(X[:, k], y), abs=1e-9)
        assert info[k]["mi"] == pytest.approx(mi(X[:, k], X[:, 0]), abs=1e-9)
        assert info[k]["cmi"] == pytest.approx(cmi(X[:, k], X[:, 0], y), abs=1e-9)
        assert info[k]["rel"] >= -1e-12 and info[k]["mi"] >= -1e-12 and info[k]["cmi"] >= -1e-12
    assert info[0]["mi"] == pytest.approx(entropy(X[:, 0]), abs=1e-9)   # I(X;X) = H(X)


@SETTINGS
@given(matrices())
def test_redundancy_is_symmetric(spark, m):
    X, y = m
    df = frame(spark, X, y)
    a = {r["k"]: r["mi"] for r in I.information(I.dense_cells(df, given=0)).collect()}
    b = {r["k"]: r["mi"] for r in I.information(I.dense_cells(df, given=1)).collect()}
    assert a[1] == pytest.approx(b[0], abs=1e-12)
