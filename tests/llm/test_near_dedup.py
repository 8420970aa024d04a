"""Near-duplicate groups against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import near_dedup as N
from tests.conftest import SF_SMALL
from tests.llm import plain


def made(seed: int = 2) -> list[tuple]:
    rnd = random.Random(seed)
    words = [f"v{i}" for i in range(400)]
    rows, shared = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  two"), (8, "two one")], rnd.choices(words, k=60)
    base = rnd.choices(words, k=120)
    for i in range(100, 160):                            # copies of one text with 0 to 8 words changed
        text = list(base)
        for _ in range(i % 9):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        rows.append((i, " ".join(text)))
    for i in range(200, 230):                            # texts that share half of their words
        rows.append((i, " ".join(shared + rnd.choices(words, k=60))))
    return rows + [(i, " ".join(base)) for i in range(300, 340)] + [(400, " ".join(rnd.choices(words, k=60_000)))]


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_all_links_are_kept(spark, n, percent):
    rows = made()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, comp string")
    got = {r.id: (r.n, r.comp) for r in N.near_groups(df, shingle=n, percent=percent).collect()}
    want = plain.groups(rows, n, percent)
    assert got == {i: (len(plain.shingles(t, n)), want[i]) for i, t in rows}
    kept = N.keep_one(df, shingle=n, percent=percent)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_repeated_and_null_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(1, a), (1, b), (1, a), (2, a), (3, b), (None, a), (4, "other words entirely"), (None, a)], "doc_id long, text string")
    got = sorted((str(r.id), str(r.comp)) for r in N.near_groups(df).collect())
    assert got == sorted([("1", "1")] * 3 + [("2", "1"), ("3", "1"), ("4", "4")] + [("None", "None")] * 2)
    kept = sorted((str(r.doc_id), r.text[:2]) for r in N.keep_one(df, shingle=3, percent=85).collect())
    assert kept == [("1", "a0"), ("4", "ot"), ("None", "a0"), ("None", "a0")]


def altered(rnd, base, words, share):
    """The text with runs of four words replaced, until about that share of its five-word shingles is new."""
    text, gone = list(base), 0
    while gone < share * len(base):
        at = rnd.randrange(len(text) - 4)
        text[at:at + 4] = rnd.choices(words, k=4)
        gone += 8
    return " ".join(text)


@pytest.mark.parametrize("families", [3])
def test_altered_copies_that_are_not_linked_do_not_meet(spark, monkeypatch, families):
    """A bucket full of copies of one text, altered in different places: few pairs of them are compared, and no link is lost."""
    rnd = random.Random(families)
    words = [f"w{i}" for i in range(3000)]
    bases = [rnd.choices(words, k=300) for _ in range(families)]
    rows = [(i, altered(rnd, bases[i % families], words, rnd.choice([0.04, 0.1, 0.15, 0.2, 0.25, 0.3]))) for i in range(450)]
    rows += [(1000 + i, rows[i][1] + " end of the text") for i in range(0, 450, 9)]          # links between altered copies
    met = []
    inner = N._share_differences
    monkeypatch.setattr(N, "_share_differences", lambda *a: met.append(inner(*a)) or met[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.comp for r in N.near_groups(df, shingle=5, percent=80).collect()}
    assert got == plain.groups(rows, 5, 80)
    assert len(set(got.values())) > 150                                  # most are not linked
    assert met and met[0].count() < 5 * len(rows)                        # of 125,000 pairs


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_groups(df).count() == 0 and N.keep_one(df).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_bands_reach_the_recall(percent):
    rows, bands = N.bands_for(percent)
    assert rows * bands <= N.COORDINATES and (1 - (percent / 100) ** rows) ** bands <= N.MISS


def test_signatures_estimate_similarity():
    rnd = random.Random(1)
    words = [f"q{i}" for i in range(5000)]
    base = rnd.sample(words, 1000)
    texts = [" ".join(base), " ".join(base[:900] + rnd.sample(words, 100))]
    doc, h = N.shingle_sets(pa.array(texts), 3)
    _, sig = N.signatures(doc, h, 128)
    a, b = (plain.shingles(t, 3) for t in texts)
    assert abs((sig[:, 0] == sig[:, 1]).mean() - len(a & b) / len(a | b)) < 0.15
    assert np.array_equal(sig, N.signatures(doc, h, 128, step=64)[1])


def test_rows_without_id_are_kept(spark, tmp_path):
    rows = [(None, "a b c d e"), (5, "a b c d e"), (None, None), (6, "a b c d e")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in N.op6_minhash_near_dedup(spark, str(tmp_path)).collect())
    assert got == [("5", "5", True), ("6", "5", False), ("None", "None", True), ("None", "None", True)]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = plain.groups(docs, 3, 85)
    got = N.op6_minhash_near_dedup(spark, SF_SMALL).collect()
    assert {r.doc_id: (r.component_id, r.kept) for r in got} == {i: (c, i == c) for i, c in want.items()}
    assert all(r.n_shingles == len(plain.shingles(t, 3)) for r, (_, t) in zip(sorted(got, key=lambda r: r.doc_id), sorted(docs)))
