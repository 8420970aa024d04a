"""Plan-shape guards for the scale design (read from the physical plans)."""

import os

import numpy as np
import pytest

from tessera.operators import infotheory as I
from tessera.operators import recommend as RC
from tessera.operators import svm as SV
from tessera.plans import views as V
from tessera.sources import ratings as RS
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables absent")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ratings_scan_is_pruned(spark):
    p = plan_of(V.ratings(spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in p
    assert "partial_avg" in p                     # map-side combine before the exchange


def test_rating_lines_are_made_and_split_once(spark):
    for rows in RS.split_rating_lines(V.rating_lines(spark, SF_SMALL)):
        p = plan_of(rows)
        assert p.count("md5(") == 1 and p.count("split(") == p.count("Generate inline") == 1      # the fields of a line come from one pass over it


def test_ratings_read_several_times_are_stored(spark):
    for rows in (*V.stored_split(spark, SF_SMALL), *V.factor_tables(spark, SF_SMALL)):
        p = plan_of(rows)
        assert "lineitem" not in p and "Exchange hashpartitioning" not in p                     # neither joined nor grouped again


def test_measures_need_two_exchanges(spark):
    cells = I.dense_cells_many(V.byte_matrix(spark, SF_SMALL), [3, 5])
    p = plan_of(I.information(cells, keys=("j", "k")))
    assert p.count("Exchange hashpartitioning") == 2       # cell key, then (j, k) for all windows
    assert "partial_count" in p


def _factors(spark, ids, seed=1, rank=3):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(int(i), [float(v) for v in rng.normal(size=rank)]) for i in ids], "id int, features array<double>")


def test_topk_small_right_side_is_spread_and_needs_no_merge(spark):
    got = RC.top_k(_factors(spark, range(50)), _factors(spark, range(40)), 5)
    p = plan_of(got)
    assert "MapInPandas" in p and "FlatMapCoGroupsInPandas" not in p and "Window" not in p
    assert p.count("Exchange") == 1                       # the left rows, dealt to the tasks
    assert got.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_topk_few_left_ids_never_collect_the_big_side(spark):
    left, right = _factors(spark, range(3)), _factors(spark, range(500), 2)
    got = RC.top_k(left, right, 5)
    p = plan_of(got)
    assert "MapInPandas" in p and "Window" in p            # k best per partition, merged
    blocked = RC.top_k(left, right, 5, max_broadcast_bytes=0)
    key = lambda r: (r.id, r.rank, r.other, r.score)
    assert sorted(map(key, got.collect())) == sorted(map(key, blocked.collect()))


def test_marginals_need_three_sorts(spark):
    cells = I.dense_cells_many(V.byte_matrix(spark, SF_SMALL), [3, 5])
    p = plan_of(I.information(cells, keys=("j", "k")))
    assert p.count("Window [") == 7 and p.count("Sort [") == 3


def test_sparse_rounds_join_once(spark):
    e = spark.createDataFrame([(i, 0, i % 4, 1) for i in range(40)], "id long, y tinyint, k int, v tinyint")
    rows = e.selectExpr("id", "y").distinct()
    p = plan_of(I.sparse_cells_many(I.partition_entries(e), rows, 4, [0, 1, 2]))
    assert p.count("Join") == 1


def test_svm_iteration_is_one_partial_aggregate(spark):
    v = V.svm_vectors(spark, SF_SMALL).selectExpr("y AS label", "features")
    w = [0.0] * 64
    base = v.selectExpr("features AS x", "label * 2.0D - 1.0D AS s", "1.0D AS wt",
                        f"{SV.margin_sql('features', w)} AS m")
    q = base.selectExpr("sum(CASE WHEN s * m < 1.0D THEN -wt * s ELSE 0.0D END * x[0]) AS g0")
    p = plan_of(q)
    assert p.count("Exchange") == 1 and "SinglePartition" in p and "partial_sum" in p
