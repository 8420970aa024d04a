"""Factor scoring, blocked top-k, RMSE, ALS invariants, splits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import recommend as RC
from tessera.operators.split import hash_split, with_row_id


def factors(spark, ids, mat):
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids, mat)],
                                 "id int, features array<double>")


def brute_topk(U, uid, V, vid, k):
    S = np.round(U @ V.T, 6)
    out = {}
    for r, u in enumerate(uid):
        order = sorted(range(len(vid)), key=lambda c: (-S[r, c], vid[c]))[:k]
        out[u] = [(vid[c], S[r, c]) for c in order]
    return out


@pytest.mark.parametrize("block_rows,bcast", [(4096, 0), (7, 0), (4096, 1 << 20)])
def test_topk_matches_bruteforce_with_ties(spark, block_rows, bcast):
    rng = np.random.default_rng(5)
    U = rng.integers(-2, 3, (23, 3)).astype(float)        # small integers: many exact ties
    V = rng.integers(-2, 3, (31, 3)).astype(float)
    uid, vid = list(range(100, 123)), list(range(500, 531))[::-1]
    got = RC.top_k(factors(spark, uid, U), factors(spark, vid, V), 4, block_rows=block_rows,
                   max_broadcast_bytes=bcast)
    rows = got.collect()
    want = brute_topk(U, uid, V, vid, 4)
    by_user = {}
    for r in rows:
        by_user.setdefault(r["id"], []).append((r["rank"], r["other"], r["score"]))
    for u, lst in by_user.items():
        lst.sort()
        assert [(o, s) for _, o, s in lst] == [(o, pytest.approx(s)) for o, s in want[u]]
        assert [rk for rk, _, _ in lst] == [1, 2, 3, 4]
    assert len(by_user) == len(uid)
    assert len(rows) == 4 * len(uid)


def test_topk_many_blocks_covers_every_left_id(spark):
    rng = np.random.default_rng(9)
    U, V = rng.normal(size=(300, 3)), rng.normal(size=(200, 3))
    got = RC.top_k(factors(spark, range(300), U), factors(spark, range(1000, 1200), V), 5,
                   block_rows=32, max_broadcast_bytes=0)
    assert got.count() == 300 * 5
    same = RC.top_k(factors(spark, range(300), U), factors(spark, range(1000, 1200), V), 5)
    assert same.exceptAll(got).count() == 0
    want = brute_topk(U, list(range(300)), V, list(range(1000, 1200)), 5)
    for r in got.where("id IN (0, 17, 299)").collect():
        assert want[r["id"]][r["rank"] - 1][0] == r["other"]


def test_topk_subset_and_nest(spark):
    rng = np.random.default_rng(2)
    U, V = rng.normal(size=(10, 4)), rng.normal(size=(12, 4))
    uf, vf = factors(spark, range(10), U), factors(spark, range(12), V)
    ids = spark.createDataFrame([(1,), (3,), (99,)], "id int")
    sub = RC.top_k_subset(ids, uf, vf, 3)
    assert sorted({r["id"] for r in sub.collect()}) == [1, 3]
    nested = RC.nest(sub).orderBy("id").collect()
    assert [len(r["recommendations"]) for r in nested] == [3, 3]
    scores = [x["rating"] for x in nested[0]["recommendations"]]
    assert scores == sorted(scores, reverse=True)


def test_predict_pairs_cold_start_and_rmse(spark):
    uf = factors(spark, [1, 2], [[1.0, 0.0], [0.0, 2.0]])
    vf = factors(spark, [10, 11], [[3.0, 1.0], [1.0, 1.0]])
    pairs = spark.createDataFrame([(1, 10, 4.0), (2, 11, 1.0), (3, 10, 2.0), (1, 12, 5.0)],
                                  "user int, item int, rating double")
    kept = RC.predict_pairs(pairs, uf, vf).orderBy("user").collect()
    assert [(r.user, r.item, r.prediction) for r in kept] == [(1, 10, 3.0), (2, 11, 2.0)]
    allp = RC.predict_pairs(pairs, uf, vf, drop_cold=False)
    assert allp.count() == 4 and allp.where("prediction IS NULL").count() == 2
    assert RC.rmse(RC.predict_pairs(pairs, uf, vf)).first()["rmse"] == pytest.approx(1.0)


def test_first_ids(spark):
    df = spark.createDataFrame([(5,), (2,), (9,), (2,), (7,)], "user int")
    assert [r.user for r in RC.first_ids(df, "user", 3).collect()] == [2, 5, 7]


def test_first_ids_are_found_once(spark):
    """Reading the ids again, as the subset queries do, does not go over the table again."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf
    got = RC.first_ids(spark.range(100).selectExpr("id % 7 AS u").mapInPandas(count, "u bigint"), "u", 3)
    for _ in range(3):
        assert [r.u for r in got.collect()] == [0, 1, 2]
    assert seen.value == 100


def test_pairs_are_joined_in_the_precision_of_the_factors(spark):
    """Single-precision factors are shuffled as they are, and widened for the dot product."""
    rng = np.random.default_rng(2)
    single = [(k, [float(x) for x in rng.random(3).astype(np.float32)]) for k in range(9)]
    uf = spark.createDataFrame(single, "id int, features array<float>")
    pairs = spark.createDataFrame([(a, b) for a in range(9) for b in range(9)], "user int, item int")
    got = RC.predict_pairs(pairs, uf, uf)
    assert all(r.prediction == sum(x * y for x, y in zip(single[r.user][1], single[r.item][1])) for r in got.collect())
    class Model:
        userFactors = itemFactors = uf
        transform = staticmethod(lambda test: test.withColumn("prediction", F.lit(0.0)))
        getPredictionCol = staticmethod(lambda: "prediction")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = RC.prediction_facts(Model, pairs)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "array<double>" not in plan[plan.index("Join"):]


def test_als_has_few_blocks(spark):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(30) for i in range(20) if (u + i) % 3]
    model = RC.fit_als(spark.createDataFrame(rows, "user int, item int, rating double"), setting={"maxIter": 1, "rank": 2, "regParam": 0.1})
    assert {t.rdd.getNumPartitions() for t in (model.userFactors, model.itemFactors)} == {RC.ALS_BLOCKS}


def test_rank1_half_step(spark):
    r = spark.createDataFrame([(1, 10, 4.0), (1, 11, 2.0), (2, 10, 5.0)],
                              "user int, item int, rating double")
    items = spark.createDataFrame([(10, 1.0), (11, 1.0)], "id int, f double")
    u = {x.id: x.f for x in RC.rank1_half_step(r, items, "user", "item", 0.1).collect()}
    assert u[1] == pytest.approx(6.0 / (2.0 + 0.2))
    assert u[2] == pytest.approx(5.0 / (1.0 + 0.1))


def test_als_user_factors_solve_normal_equations(spark):
    rng = np.random.default_rng(0)
    rows = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(30) for i in range(25)
            if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    lam = 0.1
    model = RC.fit_als(df, setting={"maxIter": 3, "rank": 3, "regParam": lam})
    Uf = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    Vf = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    for u in list(Uf)[:10]:
        mine = [(i, r) for uu, i, r in rows if uu == u]
        A = sum(np.outer(Vf[i], Vf[i]) for i, _ in mine) + lam * len(mine) * np.eye(3)
        b = sum(r * Vf[i] for i, r in mine)
        assert np.abs(A @ Uf[u] - b).max() < 1e-2
    recs = model.recommendForAllUsers(5).collect()
    for r in recs:
        ids = [x["item"] for x in r["recommendations"]]
        sc = [x["rating"] for x in r["recommendations"]]
        assert len(ids) <= 5 and len(set(ids)) == len(ids) and sc == sorted(sc, reverse=True)
    # the native top-k over the same factors gives the same lists (up to float ties)
    native = {r["user"]: r["recommendations"] for r in RC.recommend_for_all(model, 5).collect()}
    assert set(native) == {r["user"] for r in recs}
    for r in recs:
        got = native[r["user"]]
        assert [x["rating"] for x in got] == pytest.approx([x["rating"] for x in r["recommendations"]],
                                                           abs=1e-5)
        assert got[0]["item"] == r["recommendations"][0]["item"] or \
            abs(got[0]["rating"] - got[1]["rating"]) < 1e-5


def test_hash_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(2000).selectExpr("CAST(id AS INT) AS user", "CAST(id % 7 AS INT) AS item")
    a, b = hash_split(df, ["user", "item"], 0.8)
    na, nb = a.count(), b.count()
    assert na + nb == 2000 and 1400 < na < 1800
    assert a.join(b, ["user", "item"]).count() == 0
    a2, _ = hash_split(df.repartition(5), ["user", "item"], 0.8)
    assert a.exceptAll(a2).count() == 0


def test_with_row_id(spark):
    df = spark.createDataFrame([(c,) for c in "qwertyuiopasdfg"], "c string")
    got = with_row_id(df, ["c"]).orderBy("rid").collect()
    assert [r.rid for r in got] == list(range(15))
    assert [r.c for r in got] == sorted("qwertyuiopasdfg")
    big = spark.range(5000).selectExpr("(id * 7919) % 5003 AS key").repartition(7)
    ids = with_row_id(big, ["key"]).orderBy("key").select("rid").collect()
    assert [r.rid for r in ids] == list(range(5000))


def best_by_hand(lids, U, rids, V, k):
    out = []
    for i, u in zip(lids, U):
        scores = sorted((-(round(float(x), 6) + 0.0), int(r)) for r, x in zip(rids, np.round(V @ u, 6)))
        out += [(int(i), n + 1, r, -s) for n, (s, r) in enumerate(scores[:k])]
    return sorted(out)


STRATEGIES = {"small right": {}, "blocks": {"max_broadcast_bytes": 8, "block_rows": 150}, "one block": {"max_broadcast_bytes": 8}}


@pytest.mark.parametrize("how", STRATEGIES)
@pytest.mark.parametrize("norms", ["spread", "equal", "ties"])
def test_pruned_search_is_exact_and_counts(spark, how, norms):
    rng = np.random.default_rng(5)
    U, V = rng.normal(size=(90, 6)), rng.normal(size=(1300, 6))
    if norms == "spread":
        V *= rng.pareto(1.5, 1300)[:, None] + 0.01
    elif norms == "equal":
        V /= np.sqrt((V * V).sum(axis=1))[:, None]
    else:
        V = np.round(V)
        V[::3] = V[0]
        U[4] = 0.0
    lids, rids = np.arange(90), rng.permutation(1300) + 7
    left, right = factors(spark, lids, U), factors(spark, rids, V)
    got = RC.top_k(left, right, 5, counts=True, **STRATEGIES[how]).collect()
    assert sorted((r.id, r["rank"], r.other, r.score) for r in got) == best_by_hand(lids, U, rids, V, 5)
    per = {r.id: (r.scored, r.skipped) for r in got}
    assert all(a + b == 1300 and a >= 5 for a, b in per.values())
    if norms == "spread":
        assert sum(b for _, b in per.values()) > 0.3 * 90 * 1300
    plain = RC.top_k(left, right, 5, **STRATEGIES[how])
    assert plain.columns == ["id", "rank", "other", "score"] and plain.count() == len(got)


def test_few_left_rows_and_large_k(spark):
    rng = np.random.default_rng(6)
    U, V = rng.normal(size=(3, 4)), rng.normal(size=(200, 4)) * rng.pareto(1.0, 200)[:, None]
    left, right = factors(spark, range(3), U), factors(spark, range(200), V)
    got = RC.top_k(left, right, 4, counts=True)
    assert sorted(tuple(r)[:4] for r in got.collect()) == best_by_hand(range(3), U, range(200), V, 4)
    few = RC.top_k(right, left, 10, max_broadcast_bytes=8, block_rows=2, counts=True).collect()
    assert len(few) == 600 and all(r.scored == 3 for r in few)
    assert sorted((r.id, r["rank"], r.other, r.score) for r in few) == best_by_hand(range(200), V, range(3), U, 10)


def test_equal_norms_in_clusters_are_skipped_by_their_balls(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 16))
    V = centres[np.arange(2400) % 60] + 0.01 * rng.normal(size=(2400, 16))
    V /= np.sqrt((V * V).sum(axis=1))[:, None]
    U, lids, rids = V[::30] * 2, np.arange(80), rng.permutation(2400) + 3
    got = RC.top_k(factors(spark, lids, U), factors(spark, rids, V), 5, counts=True, max_broadcast_bytes=8, block_rows=200).collect()
    assert sorted((r.id, r["rank"], r.other, r.score) for r in got) == best_by_hand(lids, U, rids, V, 5)
    assert all(r.scored + r.skipped == 2400 for r in got)
    assert sum({r.id: r.skipped for r in got}.values()) > 0.5 * 80 * 2400         # the norms alone skip nothing


def exchanged_bytes(plan):
    """Bytes of all shuffles of an executed plan."""
    kind = plan.getClass().getSimpleName()
    below = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else \
        [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.metrics().get("dataSize").get().value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(exchanged_bytes(p) for p in below)


def test_rows_travel_packed_if_nothing_can_be_left_out(spark):
    """Single-precision vectors of equal norm without clusters: nearly every left row asks for every block."""
    rng = np.random.default_rng(11)
    U, V = (rng.normal(size=(n, 64)) for n in (9000, 1600))
    U, V = ((x / np.sqrt((x * x).sum(axis=1))[:, None]).astype(np.float32).astype(float) for x in (U, V))
    got = RC.top_k(factors(spark, range(9000), U), factors(spark, range(1600), V), 5, max_broadcast_bytes=8, block_rows=400)
    rows = sorted(tuple(r) for r in got.collect())
    assert len(rows) == 45_000 and rows[:200] == best_by_hand(range(40), U[:40], range(1600), V, 5)
    sent = 9000 * 3 + 1600 * math.ceil(9000 * 3 / 4 / 400)                       # three more blocks of each left row, every lot's block
    assert sent * 256 < exchanged_bytes(got._jdf.queryExecution().executedPlan()) < 0.75 * sent * 64 * 8


def test_default_blocks_are_as_large_as_a_task_can_hold(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(RC, "_two_big_sides", lambda L, R, n_left, n_right, k, digits, block_rows, *more: seen.append(block_rows) or L.selectExpr(
        "lid", "1L AS rid", "0D AS score", "1 AS rank", "0L AS scored"))
    for dim in (10, 64):
        t = factors(spark, range(3), np.ones((3, dim)))
        RC.top_k(t, t, 10, max_broadcast_bytes=8)
    assert seen[0] > 400_000 and seen[1] > 150_000 and all(n * (8 * d + 192) <= RC.BLOCK_BYTES for n, d in zip(seen, (10, 64)))


@pytest.mark.parametrize("size", [1.0, 1e3, 1e-3, 1e25])
@pytest.mark.parametrize("how", STRATEGIES)
def test_scores_closer_than_single_precision(spark, how, size):
    """The single-precision scores only leave out what can't be among the best."""
    rng = np.random.default_rng(12)
    V = np.repeat(rng.normal(size=(4, 8)), 300, axis=0) * size
    V[:, 0] += rng.integers(0, 40, 1200) * 2e-6
    U = np.vstack([np.eye(8)[:1], rng.normal(size=(30, 8))])
    got = RC.top_k(factors(spark, range(31), U), factors(spark, range(1200), V), 7, **STRATEGIES[how]).collect()
    by_hand = {(i, n): (r, s) for i, n, r, s in best_by_hand(range(31), U, range(1200), V, 7)}
    assert len(got) == 31 * 7
    for r in got:
        other, score = by_hand[r.id, r["rank"]]
        assert r.score == pytest.approx(score, rel=1e-14, abs=1.1e-6)
        assert size > 1 or r.other == other
