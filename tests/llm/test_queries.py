"""What the subpackage registers."""

from tessera.llm.queries import ORACLES, QUERIES


def test_oracles_are_sql_texts_of_queries():
    assert set(ORACLES) < set(QUERIES)
    assert all(isinstance(sql, str) for sql in ORACLES.values()) and all(callable(q) for q in QUERIES.values())
