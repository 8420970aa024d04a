"""Nearest neighbours: recall against brute force, and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import neighbours as N
from tests.conftest import SF_SMALL


def brute(vectors: dict, queries, k: int) -> dict:
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in queries:
        s = x @ np.array(vectors[q], float)
        keep = ids != q
        order = np.lexsort((ids[keep], -s[keep]))[:k]
        out[q] = list(zip(ids[keep][order], s[keep][order]))
    return out


def recall(rows, want: dict) -> float:
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q, near in want.items():
        mine = sorted(got.get(q, []))
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(near)
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(mine, mine[1:]))
        hits += len({v for _, v, _ in mine} & {v for v, _ in near})
    return hits / max(1, sum(map(len, want.values())))


def test_odd_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=8)], 1.0) for i in range(1, 200)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1.0) for i in range(300, 420)]       # many equal vectors
    rows += [(500, None, 1.0), (501, [0.0] * 8, 1.0), (502, [1.0, None] + [0.0] * 6, 1.0), (503, [float("nan")] + [1.0] * 7, 1.0),
             (504, [float("inf")] + [1.0] * 7, 1.0), (505, [1.0], 1.0), (None, [1.0] * 8, 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    got = N.search(df, F.col("vec_id") % 20 == 0, k=7).collect()
    good = {i: v for i, v, _ in rows if i is not None and i < 500}
    want = brute(good, [i for i in good if i % 20 == 0], 7)
    assert {r.query_id for r in got} == set(want) and recall(got, want) == 1.0
    exact = {(q, v): s for q, near in want.items() for v, s in near}
    assert all(abs(r.score - exact[r.query_id, r.vec_id]) < 1e-12 for r in got)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    df = spark.createDataFrame([(i * 20, [1.0, float(i)]) for i in range(n)], "vec_id long, embedding array<float>")
    got = N.search(df, F.col("vec_id") % 20 == 0, k=5).collect()
    assert len(got) == n * (n - 1)


def test_recall_below_a_full_scan(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = N.search(df, F.col("vec_id") % 100 == 0, k=10, least=200, block=500).collect()
    assert recall(got, brute({i: list(v) for i, v in enumerate(x)}, range(0, 3000, 100), 10)) >= 0.9


def clusters(rng, groups: int, each: int, dim: int) -> np.ndarray:
    centres = rng.normal(size=(groups, dim))
    return np.repeat(centres, each, axis=0) + 0.05 * rng.normal(size=(groups * each, dim))


def forest_of(spark, tmp_dir, x, trees=6, block=64):
    df = spark.createDataFrame([(int(i), [float(a) for a in v], i % 20 == 0) for i, v in enumerate(x)], "vid long, vector array<double>, asks boolean")
    return N.build(df, len(x), x.shape[1], float(np.linalg.norm(x, axis=1).max()), tmp_dir, trees, block)


def test_clusters_need_few_candidates(spark, tmp_dir):
    rng = np.random.default_rng(3)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x, loose = unit(clusters(rng, 150, 20, 24)), unit(rng.normal(size=(3000, 24)))
    forest, other = forest_of(spark, f"{tmp_dir}/x", x, trees=N.TREES), forest_of(spark, f"{tmp_dir}/loose", loose, trees=N.TREES)
    ranges = N.descend(forest)
    need = N.fit_need(forest, ranges, 10)
    assert need < N.fit_need(other, N.descend(other), 10) / 4        # the share that recall takes is the data's
    chosen = N.ascend(forest, ranges, need).withColumn("rows", F.col("hi") - F.col("lo")).agg(F.sum("rows") / F.countDistinct("qid")).first()[0]
    assert need <= chosen < len(x) * N.TREES / 10
    found = {}
    for r in N.score(forest, N.ascend(forest, ranges, need), 11).collect():
        found.setdefault(r.qid, {})[r.vid] = r.score
    hits = 0
    for q in range(0, len(x), 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:10].tolist()) & set(found[q]))
    assert hits >= 0.9 * 10 * len(found) and len(found) == 150


def test_ranges_hold_every_row_with_the_prefix(spark, tmp_dir):
    x = clusters(np.random.default_rng(5), 20, 15, 12)
    forest = forest_of(spark, tmp_dir, x, trees=3, block=16)
    stored = {r.vid: r for r in forest.rows.collect()}
    place = {(bytes(r.key)[0], r.vid): r.pos for r in forest.arrays.collect()}
    assert sorted(place.values()) == list(range(3 * len(x)))
    bits = lambda key: np.unpackbits(np.frombuffer(bytes(key), np.uint8)[1:])
    longest = 0
    for r in N.descend(forest).collect():
        own = bits(stored[r.qid].asked[r.tree])[:r.level]
        within = [v for v, row in stored.items() if (bits(row.strings[r.tree])[:r.level] == own).all()]
        assert all(r.lo <= place[r.tree, v] < r.hi for v in within)
        assert r.hi - r.lo <= len(within) + 2 * 16                # rounded up by less than a block at either end
        longest = max(longest, r.level)
    assert longest > 8


def test_more_need_means_longer_ranges_up_to_one_tree(spark, tmp_dir):
    x = clusters(np.random.default_rng(6), 30, 10, 12)
    forest = forest_of(spark, tmp_dir, x, trees=4, block=16)
    ranges = N.descend(forest)
    length = [N.ascend(forest, ranges, need).agg(F.sum(F.col("hi") - F.col("lo"))).first()[0] / 15 for need in (1, 40, 4 * len(x))]
    assert length[0] <= length[1] and length[1] >= 40 and length[2] == len(x)


def test_hot_blocks_are_met_in_parts(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(N, "PART", 3)
    x = clusters(np.random.default_rng(8), 1, 300, 12)              # one region holds all rows and queries
    forest = forest_of(spark, tmp_dir, x, trees=4, block=32)
    ranges = N.descend(forest)
    got = {(r.qid, r.vid): r.score for r in N.score(forest, N.ascend(forest, ranges, 4 * len(x)), len(x)).collect()}
    assert len(got) == 15 * 300
    assert all(abs(s - x[q] @ x[v]) < 1e-9 for (q, v), s in got.items())


def test_strings_share_prefixes_when_near():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(400, 16))
    b = a + 0.05 * rng.normal(size=a.shape)
    own, near, far = (N.hash_strings(v, np.zeros(16), 6, 1)[:, :, 1:] for v in (a, b, rng.normal(size=a.shape)))
    assert N.shared_bits(own, near).mean() > 5 * N.shared_bits(own, far).mean()
    assert (N.shared_bits(own, own) == N.BITS).all()


def test_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    vectors = {r.vec_id: list(r.embedding) for r in rows}
    got = N.op7_hash_forest_ann(spark, SF_SMALL).collect()
    assert recall(got, brute(vectors, [i for i in vectors if i % 20 == 0], 20)) >= 0.9
