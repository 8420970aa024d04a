"""Decontamination against a plain scan."""

import pytest

from tessera.llm import decontamination as D
from tests.conftest import SF_SMALL
from tests.llm import plain
from tests.oracle_check import compare, duck

LONG = " ".join(f"w{i}" for i in range(40))
ITEMS = [(1, LONG), (2, "two words"), (3, None), (4, ""), (5, "... !!"), (6, "single"), (None, "named by nothing at all"), (1, LONG), (7, "Three SHORT ones"),
         (8, "é日 " * 12)]
DOCS = [(1, "x " + LONG + " y"), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (3, "a W3, w4 w5 w6 w7 w8 w9 w10 w11 w12 b"), (4, None), (5, ""), (6, "here TWO... words"),
        (7, "two words two words single"), (None, "single"), (8, "named by nothing at all"), (9, "three short ones " * 3 + "z " * 200_000),
        (3, "a W3, w4 w5 w6 w7 w8 w9 w10 w11 w12 b"), (3, "another text"), (10, "É日 é日 " * 8)]


def test_against_plain(spark):
    docs = spark.createDataFrame([(*r, 1) for r in DOCS], "doc_id long, text string, n_words int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((str(r.id), r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in D.contamination_report(docs, items).collect())
    want = []
    for i, text in DOCS:
        n, hit, names = plain.contamination(text, ITEMS)
        want.append((str(i), n, hit, len(names), ",".join(names), hit > 0))
    assert got == sorted(want)
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(w[0] for w in want if not w[5])


def test_small_bitset_changes_nothing(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, D.contamination_report(docs, items, bits=64).collect())) == sorted(map(key, D.contamination_report(docs, items).collect()))


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_empty_tables(spark, empty):
    docs = spark.createDataFrame([] if empty == "docs" else DOCS, "doc_id long, text string")
    items = spark.createDataFrame([] if empty == "items" else ITEMS, "item_id long, text string")
    got = D.contamination_report(docs, items).collect()
    assert len(got) == (0 if empty == "docs" else len(DOCS)) and not any(r.contaminated for r in got)


def test_query_matches_oracle(spark):
    ok, msg, _, _ = compare(spark, duck(SF_SMALL), "op1", D.op1_decontamination, D.ORACLE, SF_SMALL)
    assert ok, msg
