"""Headline workloads, timed.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Workloads (the reference's three programs at their stated settings):
  select_7x10       greedy selection, all seven criteria, 10 features each (EMB, 2,000 rows at sf0.1)
  select_lineitem   greedy selection, all seven criteria, all 4 features of LIN (600,000 rows)
  mi_lineitem       contingency counts + relevance of the LIN matrix
  ratings_ingest    parse the ratings feed, split 80/20, count both sides
  ratings_view      build the (user, item, rating) table from lineitem x orders, persisted
  als_spark_program ALS maxIter 5, regParam 0.01; RMSE on the test side; top 10 items
                    per user and top 10 users per item (native top-k over the model's
                    factors), and both 3-id subsets (recommendFor*Subset)
  als_flink_program ALS 10 iterations, rank 10, lambda 0.1; test predictions
  topk_native       blocked top-10 items for every user over factor tables
  svm_sgd_20        parse labeled lines, 20 subgradient steps, test accuracy
  svc_20            weighted LinearSvc, 20 iterations, mini-batches of 32
  svm_lineitem      10 subgradient steps over vectors of all lineitem rows, accuracy on them
  svc_lineitem      LinearSvc with its defaults over the same rows, 20 mini-batches of 32
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tessera.session import build_session
    spark = build_session(f"local[{cpus}]", app="tessera-bench",
                          shuffle_partitions=int(cpus))

    from pyspark.sql import functions as F

    from tessera.operators import criteria as C
    from tessera.operators import infotheory as I
    from tessera.operators import recommend as RC
    from tessera.operators import selection as S
    from tessera.operators import svm as SV
    from tessera.operators.split import hash_split
    from tessera.plans import views as V
    from tessera.sources import labeled as LB
    from tessera.sources import ratings as RS

    spark.range(1000).selectExpr("sum(id)").collect()     # session warm-up, untimed
    timings: dict[str, float] = {}
    notes: dict[str, object] = {}

    def timed(name):
        def deco(fn):
            t0 = time.perf_counter()
            notes[name] = fn()
            timings[name] = round(time.perf_counter() - t0, 3)
            return fn
        return deco

    @timed("select_7x10")
    def _():
        src = S.BitSlicedFeatures(V.byte_matrix(spark, sf_dir))
        try:
            res = S.greedy_select_many(src, list(C.CRITERIA), 10)
        finally:
            src.release()
        return {c: s.features for c, s in res.items()}["mrmr"]

    @timed("select_lineitem")
    def _():
        src = S.DenseFeatures(V.lineitem_matrix(spark, sf_dir))
        try:
            res = S.greedy_select_many(src, list(C.CRITERIA), 4)
        finally:
            src.release()
        return {c: s.features for c, s in res.items()}["mrmr"]

    @timed("mi_lineitem")
    def _():
        rel = I.relevance(I.dense_cells(V.lineitem_matrix(spark, sf_dir)))
        return len(rel.collect())

    @timed("ratings_ingest")
    def _():
        return list(RS.ingest_summary(V.rating_lines(spark, sf_dir), ["user", "item"], 0.8))

    train, test = V.rating_split(spark, sf_dir)
    train = train.persist()
    test = test.persist()

    @timed("ratings_view")
    def _():
        return [train.count(), test.count()]     # lineitem x orders -> (user, item) ratings

    @timed("als_spark_program")
    def _():
        # fit once (maxIter 5, regParam 0.01), then every output of the program
        model = RC.fit_als(train)
        rmse = RC.als_rmse(model, test)
        users = RC.first_ids(train, "user", 3)
        items = RC.first_ids(train, "item", 3)
        n = [RC.recommend_for_all(model, 10).count(),
             RC.recommend_for_all(model, 10, users=False).count(),
             model.recommendForUserSubset(users, 10).count(),
             model.recommendForItemSubset(items, 10).count()]
        return [round(rmse, 4)] + n

    @timed("als_flink_program")
    def _():
        model = RC.fit_als(train, setting=RC.FLINK_SETTING)
        return model.transform(test).select("rating", "prediction").count()

    @timed("topk_native")
    def _():
        uf, vf = V.factor_tables(spark, sf_dir, train)
        return RC.top_k(uf, vf, 10).count()

    @timed("svm_sgd_20")
    def _():
        good, _ = LB.split_labeled_lines(V.svm_lines(spark, sf_dir))
        rows = good.select(F.col("tag").cast("bigint").alias("id"), "label", "features")
        tr, te = hash_split(rows, ["id"], 0.8)
        w = SV.sgd_svm(tr, 20)
        return round(SV.accuracy(SV.predict(te, w)).first()["accuracy"], 4)

    @timed("svc_20")
    def _():
        v = V.svm_vectors(spark, sf_dir).withColumnRenamed("y", "label")
        model = SV.LinearSvc(weightCol="wt", idCol="id", maxIter=20, reg=0.01).fit(v)
        return len(model.coefficients)

    lines = V.svm_lineitem(spark, sf_dir)

    @timed("svm_lineitem")
    def _():
        w, n = SV.sgd_svm_counted(lines, 10)
        return [n, round(SV.accuracy(SV.predict(lines, w)).first()["accuracy"], 4)]

    @timed("svc_lineitem")
    def _():
        return len(SV.LinearSvc(maxIter=20).fit(lines).coefficients)

    total = round(sum(timings.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in os.path.basename(sf_dir) else sf_dir
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": timings,
                      "sf": sf, "cpus": int(cpus), "results": notes}, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
