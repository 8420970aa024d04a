"""Row ids and splits."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.split import hash_cut, hash_split, random_split, with_row_id


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_row_ids_keep_every_row_and_column(spark, n):
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = spark.range(n).select(F.col("id").alias("o"), F.repeat(F.lit("payload "), 40).alias("text"), (F.col("id") % 3).alias("m"))
        got = with_row_id(df.orderBy(F.rand(1)), ["o"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted((r.o, r.rid) for r in got) == [(i, i) for i in range(n)]
    assert all(r.text.startswith("payload") for r in got)


def test_splits_cover_all_rows_once(spark):
    df = spark.range(10_000)
    a, b = hash_split(df, ["id"], 0.8)
    assert a.count() + b.count() == 10_000 and abs(a.count() - 8000) < 250
    assert hash_cut(1e-12) > 0 and hash_cut(1.0) == 1 << 60
    one, two = random_split(df, [0.8, 0.2], 7)
    assert one.count() + two.count() == 10_000 and one.intersect(two).count() == 0
    assert random_split(df, [0.8, 0.2], 7)[0].count() == one.count()


def test_exact_split_has_exactly_its_share(spark):
    from tessera.operators.split import exact_split
    rows = [(i, i % 50, "x") for i in range(997)] + [(5, 5, "x")] * 400 + [(None, None, "x")]
    df = spark.createDataFrame(rows, "k long, g long, side string").repartition(5)
    everything = sorted(map(str, rows))
    for keys in (["k"], ["g"], ["side"]):
        for fraction in (0.0, 0.3, 0.8, 1.0):
            main, rest = (sorted(str(tuple(r)) for r in side.collect()) for side in exact_split(df, keys, fraction))
            assert len(main) == int(fraction * len(rows) + 0.5)
            assert sorted(main + rest) == everything
    main, rest = exact_split(df.limit(0), ["k"], 0.5)
    assert main.count() == rest.count() == 0
