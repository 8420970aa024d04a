"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as E
from tessera.plans.catalog import QUERIES as CATALOG
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

CORE = E.queries()
QUERIES = {n: f for n, f in CORE.items() if n in CATALOG}
ORACLES = {n: q for n, q in E.oracle_sql().items() if n in CATALOG}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg, _, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) == set(CATALOG)


def test_every_query_has_docstring():
    from tessera.plans.catalog import QUERIES as RAW
    assert all(fn.__doc__ for fn in RAW.values())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["rank", "feat", "score"] and len(rows) == 3
