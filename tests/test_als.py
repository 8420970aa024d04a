"""Chunked ALS against plain least squares, whatever the chunks."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import als as A
from tessera.operators import recommend as RC


def plain_als(rows, start, rank, iters, reg):
    users = {u: np.array(f) for u, f in start.items()}
    rows = [r for r in rows if None not in r]
    for _ in range(iters):
        items = solve([(i, u, r) for u, i, r in rows], users, rank, reg)
        users = solve(rows, items, rank, reg)
    return users, items


def solve(rows, fixed, rank, reg):
    out = {}
    for u in {r[0] for r in rows}:
        mine = [(fixed[i], r) for v, i, r in rows if v == u and i in fixed]
        if mine:
            X, y = np.array([f for f, _ in mine]), np.array([r for _, r in mine])
            out[u] = np.linalg.solve(X.T @ X + reg * len(mine) * np.eye(rank), X.T @ y)
    return out


def made(seed=1, hot=0):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(40), rnd.randrange(25) - 5, float(rnd.randint(1, 5))) for _ in range(600)]
    rows += [(7, 10 ** 12 + k % 300, float(k % 5 + 1)) for k in range(hot)]
    return rows + [(None, 3, 2.0), (3, None, 2.0), (3, 4, None), (5, 6, 1.0), (5, 6, 4.0)]


def factors(df):
    return {r.id: np.array(r.features) for r in df.collect()}


def start_of(spark, rows, rank, seed=42):
    ids = spark.createDataFrame([(u,) for u in sorted({r[0] for r in rows if None not in r})], "id long")
    return {r.id: r.features for r in A.start_factors(ids, rank, seed).collect()}


@pytest.mark.parametrize("rank, chunk", [(1, 8192), (3, 8192), (3, 50)])
def test_equals_plain_least_squares(spark, monkeypatch, rank, chunk):
    rows = made(hot=900)
    df = spark.createDataFrame([(*r, "x") for r in rows], "user long, item long, rating double, id string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)       # a chunk is at most a batch
    try:
        model = A.fit_chunked_als(df, rank=rank, maxIter=2, regParam=0.1)
        users, items = factors(model.userFactors), factors(model.itemFactors)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want_users, want_items = plain_als(rows, start_of(spark, rows, rank), rank, 2, 0.1)
    assert set(users) == set(want_users) and set(items) == set(want_items)
    assert all(np.allclose(users[u], want_users[u], atol=1e-8) for u in users)
    assert all(np.allclose(items[i], want_items[i], atol=1e-8) for i in items)


@pytest.fixture
def all_partitions(spark):
    """Small partitions stay apart, as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_user_is_spread(spark, tmp_dir, all_partitions):
    """A user with a third of all ratings: chunks of one size, and no task with more than twice the median rows."""
    hot = spark.range(40_000).selectExpr("7L AS user", "id AS item", "1.0D AS rating")
    rest = spark.range(80_000).selectExpr("id % 5000 AS user", "id % 977 AS item", "2.0D AS rating")
    chunks = A.rating_chunks(hot.unionByName(rest).repartition(8), "user", "item", "rating", f"{tmp_dir}/chunks")
    tasks = [r.n for r in chunks.select(F.shiftright("chunk", 33).alias("task"), F.size("ids").alias("n")).groupBy("task").agg(F.sum("n").alias("n")).collect()]
    assert sum(tasks) == 120_000 and max(tasks) <= 2 * np.median(tasks)
    assert chunks.agg(F.max(F.size("ids"))).first()[0] <= A.CHUNK
    holders = chunks.where(F.array_contains("ids", 7)).select(F.shiftright("chunk", 33).alias("task")).distinct().count()
    assert holders >= 3


def test_pair_rated_very_often_is_dealt_out(spark, tmp_dir, all_partitions):
    same = spark.range(60_000).selectExpr("1L AS user", "1L AS item", "3.0D AS rating").repartition(8)
    chunks = A.rating_chunks(same, "user", "item", "rating", f"{tmp_dir}/same")
    tasks = [r.n for r in chunks.select(F.shiftright("chunk", 33).alias("task"), F.size("ids").alias("n")).groupBy("task").agg(F.sum("n").alias("n")).collect()]
    assert max(tasks) <= 2 * np.median(tasks) and len(tasks) > 2


def test_model_surface(spark):
    df = spark.createDataFrame(made(2), "user long, item long, rating double")
    model = A.fit_chunked_als(df, rank=2, maxIter=3, regParam=0.05, cold_start="nan")
    pairs = spark.createDataFrame([(1, 2, 3.0), (999, 2, 3.0)], "user long, item long, rating double")
    got = {r.user: r.prediction for r in model.transform(pairs).collect()}
    u, v = factors(model.userFactors), factors(model.itemFactors)
    assert abs(got[1] - u[1] @ v[2]) < 1e-9 and got[999] is None
    recs = model.recommendForAllUsers(3).collect()
    assert len(recs) == len(u) and all(len(r.recommendations) == 3 for r in recs)
    solved = RC.fitted_users(model, df.dropna(), 0.05).collect()
    assert solved and all(r.solved for r in solved)
    with pytest.raises(ValueError):
        A.fit_chunked_als(df, regParam=0.0)


def test_better_fit_than_the_mean(spark):
    rnd = np.random.default_rng(3)
    U, V = rnd.random((60, 2)), rnd.random((50, 2))
    rows = [(int(u), int(i), float(U[u] @ V[i])) for u in range(60) for i in range(50) if rnd.random() < 0.6]
    df = spark.createDataFrame(rows, "user long, item long, rating double")
    model = A.fit_chunked_als(df, rank=2, maxIter=8, regParam=1e-4)
    error = RC.rmse(model.transform(df)).first()[0]
    assert error < 0.02 < 0.1 < np.std([r[2] for r in rows])


def test_empty(spark):
    df = spark.createDataFrame([], "user long, item long, rating double")
    model = A.fit_chunked_als(df, rank=2, maxIter=1)
    assert model.userFactors.count() == 0 and model.itemFactors.count() == 0 and model.transform(df).count() == 0


def test_factors_go_to_a_block_once(spark, tmp_dir, monkeypatch):
    """Of many chunks, equally many form a block; a block is sent what its chunks name, once, and no id more often than there are blocks."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        pairs = spark.range(6000).selectExpr("id % 300 AS user", "pmod(xxhash64(id), 200) AS item", "1.0D AS rating")
        chunks = A.rating_chunks(pairs, "user", "item", "rating", f"{tmp_dir}/chunks")
        blocks = A.in_blocks(chunks, f"{tmp_dir}/chunks")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = blocks.chunks.orderBy("chunk").collect()
    of = [r.block for r in rows]
    assert len(rows) >= 120 and blocks.count == A.BLOCKS and of == sorted(of)
    sizes = [of.count(b) for b in range(A.BLOCKS)]
    assert max(sizes) - min(sizes) <= 1
    needs = A.block_needs(blocks, "others")
    assert {(r.id, b) for r in needs.collect() for b in r.blocks} == {(i, r.block) for r in rows for i in r.others}
    factors = A.start_factors(needs.select("id"), 2, 1)
    sent = A._met(blocks, (needs, factors)).where("id IS NOT NULL").collect()
    assert len(sent) == len({(r.block, i) for r in rows for i in r.others}) <= A.BLOCKS * needs.count()
    assert sum(len(set(r.others)) for r in rows) > 2 * len(sent)
    assert A._met(blocks, (needs, factors)).where("packed IS NOT NULL").count() == len(rows)


def test_more_blocks_for_more_ratings(spark, monkeypatch):
    """Blocks hold a bounded number of ratings, and a fit in many of them is the same."""
    monkeypatch.setattr(A, "BLOCK_RATINGS", 60)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 25)
    rows = made(4, hot=200)
    df = spark.createDataFrame(rows, "user long, item long, rating double").repartition(3)
    try:
        model = A.fit_chunked_als(df, rank=2, maxIter=2, regParam=0.1)
        users, items = factors(model.userFactors), factors(model.itemFactors)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want_users, want_items = plain_als(rows, start_of(spark, rows, 2), 2, 2, 0.1)
    assert set(users) == set(want_users) and set(items) == set(want_items)
    assert all(np.allclose(users[u], want_users[u], atol=1e-8) for u in users)


def test_residuals_of_the_normal_equations(spark):
    """Per user over the pairs of known ids, as plain sums; a null rating counts in n, repeated pairs count each."""
    rnd = np.random.default_rng(5)
    U = {u: rnd.random(2) for u in range(20)}
    V = {i: rnd.random(2) for i in range(15)}
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rnd.integers(0, 25, 400), rnd.integers(0, 18, 400), rnd.integers(1, 6, 400))]
    rows += [(3, 4, None), (3, 4, None), (None, 4, 1.0), (3, None, 1.0), (5, 5, 2.0), (5, 5, 2.0)]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    table = lambda t: spark.createDataFrame([(k, [float(x) for x in f]) for k, f in t.items()], "id int, features array<float>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    try:
        got = {r.id: r for r in A.equation_residuals(df, table(U), table(V), 2, 0.1, "user", "item", "rating").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for u, i, r in rows:
        if u in U and i in V:
            g, scale = want.get(u, (np.zeros(2), 0.0))
            g = g + 0.1 * U[u] + (V[i] * (U[u] @ V[i] - r) if r is not None else 0)
            want[u] = g, scale + abs(r or 0.0)
    assert set(got) == set(want)
    assert all(np.allclose(got[u].g, g, atol=1e-4) and abs(got[u].scale - s) < 1e-9 for u, (g, s) in want.items())


@pytest.mark.parametrize("cold", ["drop", "nan"])
def test_pairs_are_scored_in_blocks(spark, cold):
    """Every row with its own columns, as joined with the factors; ids null, unseen or repeated; no pair is joined with a factor."""
    rows = made(6)
    model = A.fit_chunked_als(spark.createDataFrame(rows, "user long, item long, rating double"), rank=3, maxIter=1, cold_start=cold)
    pairs = spark.createDataFrame([(*r, f"n{k}", [k, None]) for k, r in enumerate([*rows, (999, 2, 1.0), (1, 999, None), (None, None, 1.0)])],
                                  "user int, item int, rating double, note string, list array<int>").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 40)
    try:
        scored = model.transform(pairs)
        got = scored.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plain = RC.predict_pairs(pairs, model.userFactors, model.itemFactors, drop_cold=cold == "drop")
    assert scored.dtypes == plain.dtypes
    want = {r.note: r for r in plain.collect()}
    assert len(got) == len(want) == (len(rows) - 2 if cold == "drop" else len(rows) + 3)
    for r in got:
        w = want[r.note]
        assert tuple(r)[:-1] == tuple(w)[:-1] and (r.prediction is None) == (w.prediction is None)
        assert r.prediction is None or abs(r.prediction - w.prediction) < 1e-9
    joins = [line for line in scored._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert joins and not any("user#" in line or "item#" in line for line in joins)


def test_wide_pairs_make_more_blocks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_BYTES", 20_000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        pairs = spark.range(1000).selectExpr("id % 50 AS user", "id % 30 AS item", "sha2(string(id), 512) AS note")
        chunks = A.pair_chunks(pairs, "user", "item", f"{tmp_dir}/pairs")
        blocks = A.in_blocks(chunks, f"{tmp_dir}/pairs")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert blocks.count > A.BLOCKS
    assert blocks.chunks.groupBy("block").agg(F.sum(F.length("packed")).alias("n")).agg(F.max("n")).first()[0] < 40_000


def test_training_pairs_are_scored_where_they_are_stored(spark, tmp_dir):
    """The fit's table again, of other types and with repeated rows: no new chunks; with a null in it, or other columns, all rows come by the other way."""
    rows = [r for r in made(7) if None not in r]
    for name, table in (("whole", rows), ("null", [*rows, (3, 4, None)])):
        spark.createDataFrame(table, "user int, item int, rating float").write.parquet(f"{tmp_dir}/{name}")
        df = spark.read.parquet(f"{tmp_dir}/{name}")
        model = A.fit_chunked_als(df, rank=2, maxIter=1)
        for pairs in (df, df.withColumn("twice", F.col("rating") * 2)):
            assert model._stored(pairs) == (name == "whole" and pairs is df)
            got, plain = model.transform(pairs), RC.predict_pairs(pairs, model.userFactors, model.itemFactors)
            assert got.dtypes == plain.dtypes and got.count() == len(table)
            order = lambda t: sorted(((*r[:-1], r[-1]) for r in t.collect()), key=str)
            assert [r[:-1] for r in order(got)] == [r[:-1] for r in order(plain)]
            assert np.allclose([r[-1] for r in order(got)], [r[-1] for r in order(plain)], atol=1e-9)
        assert not model._stored(df.selectExpr("item AS user", "user AS item", "rating"))
    ids = spark.range(30).selectExpr("id AS a", "id * 7 % 30 AS b", "1.0D AS rating")
    model = A.fit_chunked_als(ids.selectExpr("a AS user", "b AS item", "rating"), rank=2, maxIter=1)
    assert model._stored(ids.selectExpr("a AS user", "b AS item", "rating")) and not model._stored(ids.selectExpr("a AS item", "b AS user", "rating"))


def test_a_task_holds_its_factors_once():
    """Single-precision factors are not widened, nor held twice while they are gathered."""
    rng = np.random.default_rng(4)
    made = [(rng.permutation(20_000) + 20_000 * k, rng.random((20_000, 10)).astype(np.float32)) for k in range(10)]
    want = {int(i): x for ids, rows in made for i, x in zip(ids[:3], rows[:3])}
    parts = [(i.copy(), x.copy()) for i, x in made]
    del made
    tracemalloc.start()
    held = A._Factors(parts, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not parts and held.rows.dtype == np.float32 and peak < 200_000 * (10 * 4 + 8 * 4)
    place, known = held.of(np.array([*want, -1]))
    assert known.tolist() == [True] * len(want) + [False]
    got = held.at(place[:-1])
    assert got.dtype == np.float64 and np.array_equal(got, np.array(list(want.values())))


def test_residuals_come_in_blocks_of_bounded_size_and_single_precision(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(u, i, float(u % 3 + 1)) for u in range(60) for i in range(10)], "user long, item long, rating double")
    tables = [spark.createDataFrame([(k, [float(x) for x in rng.random(2).astype(np.float32)]) for k in range(n)], "id long, features array<float>") for n in (60, 10)]
    wide = [t.selectExpr("id", "CAST(features AS array<double>) AS features") for t in tables]
    want = {r.id: r for r in A.equation_residuals(df, *wide, 2, 0.1, "user", "item", "rating").collect()}
    seen, met = [], A._met
    monkeypatch.setattr(A, "RESIDUAL_RATINGS", 50)
    monkeypatch.setattr(A, "_met", lambda blocks, *fed: seen.append((blocks.count, met(blocks, *fed))) or seen[-1][1])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)           # a chunk is at most a batch
    try:
        got = {r.id: r for r in A.equation_residuals(df, *tables, 2, 0.1, "user", "item", "rating").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    (count, rows), = seen
    assert count == 12 and dict(rows.dtypes)["features"] == "array<float>"
    assert set(got) == set(want) and all(np.allclose(got[u].g, want[u].g) and got[u].scale == want[u].scale for u in want)
