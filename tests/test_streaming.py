"""Fitted models as stateless projections of a file stream."""

from tessera.operators import selection as S
from tessera.operators import svm as SV
from tessera.streaming import scoring


def test_labeled_stream_scored_by_svm_and_selector(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    import os
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("1,1,1 2 3\n0,2,-1 -2 -3\nbad line\n")
    good, bad = scoring.labeled_line_stream(spark, src)
    model = SV.LinearSvcModel([1.0, 0.0, 0.0])
    scored = scoring.apply_model(good, model)
    sliced = scoring.apply_model(scored, S.FeatureSelectorModel([0, 2]).setFeaturesCol("features")
                                 .setOutputCol("sel"))
    q = scoring.run_to_table(sliced, f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    q.processAllAvailable()
    q.stop()
    out = spark.read.parquet(f"{tmp_dir}/out").orderBy("tag").collect()
    assert [(r.tag, r.prediction, list(r.sel)) for r in out] == [("1", 1.0, [1.0, 3.0]),
                                                                  ("2", 0.0, [-1.0, -3.0])]


def test_rating_stream_routes_bad_lines(spark, tmp_dir):
    import os
    src = f"{tmp_dir}/feed"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("1::2::3.5::978300760\n1::2::3\n7::8::4.0::5\n")
    good, bad = scoring.rating_line_stream(spark, src)
    qg = good.writeStream.format("memory").queryName("good_ratings").outputMode("append").start()
    qb = bad.writeStream.format("memory").queryName("bad_ratings").outputMode("append").start()
    for q in (qg, qb):
        q.processAllAvailable()
        q.stop()
    assert sorted(r.user for r in spark.sql("SELECT user FROM good_ratings").collect()) == [1, 7]
    assert [r.line for r in spark.sql("SELECT line FROM bad_ratings").collect()] == ["1::2::3"]
