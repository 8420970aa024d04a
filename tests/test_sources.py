"""Rating, CSV and labeled-line sources, with the hand-made bad lines."""

import pytest

from tessera.operators import checks as K
from tessera.sources import labeled as LB
from tessera.sources import ratings as RS


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_rating_lines_good_and_bad(spark):
    df = lines(spark, ["1::2::3.5::978300760", "1::2::3", "1::2::3::", "a::2::3::4"])
    good, bad = RS.split_rating_lines(df)
    g = good.collect()
    assert [(r.user, r.item, r.rating, r.ts) for r in g] == [(1, 2, 3.5, 978300760)]
    assert sorted(r.line for r in bad.collect()) == ["1::2::3", "1::2::3::", "a::2::3::4"]
    assert good.schema.simpleString() == "struct<user:int,item:int,rating:float,ts:bigint>"


def test_rating_strict_mode_fails(spark):
    ok = RS.parse_rating_lines(lines(spark, ["1::2::3.5::978300760"])).collect()
    assert ok[0].user == 1
    with pytest.raises(Exception):
        RS.parse_rating_lines(lines(spark, ["1::2::3"])).collect()


def test_rating_text_and_csv_files(spark, tmp_dir):
    path = f"{tmp_dir}/ratings.txt"
    with open(path, "w") as f:
        f.write("1::10::4.0::100\n2::11::5.0::200\n")
    got = RS.read_rating_text(spark, path).orderBy("user").collect()
    assert [(r.user, r.item) for r in got] == [(1, 10), (2, 11)]
    cpath = f"{tmp_dir}/ratings.csv"
    with open(cpath, "w") as f:
        f.write("1,10,4.0,100\n2,11,5.0,200\n")
    csv = RS.read_rating_csv(spark, cpath)
    assert csv.schema.simpleString() == \
        "struct<userid:bigint,movieid:bigint,rating:double,timestamp:string>"
    assert csv.count() == 2
    parsed = RS.parse_csv_lines(lines(spark, ["1,10,4.0,100"])).first()
    assert (parsed.userid, parsed.movieid, parsed.rating, parsed.timestamp) == (1, 10, 4.0, "100")


def test_ingest_summary(spark):
    df = lines(spark, ["1::2::3.5::1", "1::3::3.5::1", "bad", "2::2::1.0::5"])
    good, bad, train, test = RS.ingest_summary(df, ["user", "item"], 0.8)
    assert (good, bad, train + test) == (3, 1, 3)


def test_labeled_lines(spark):
    df = lines(spark, ["1,17,0.5 0.25 3", "1,17,0.5  3", "1,0.5", "2,17,1 1", "0,9,x 1"])
    good, bad = LB.split_labeled_lines(df)
    g = sorted((r.label, r.tag, list(r.features)) for r in good.collect())
    assert g == [(1.0, "17", [0.5, 0.25, 3.0]), (1.0, "17", [0.5, 3.0]),   # Q7: no extra zero
                 (2.0, "17", [1.0, 1.0])]
    assert sorted(r.line for r in bad.collect()) == ["0,9,x 1", "1,0.5"]   # Q16
    # label 2 parses, but the binary-label check rejects it
    viol = K.label_violations(good, "label").collect()
    assert [r.label for r in viol] == [2.0]
    with pytest.raises(ValueError):
        K.require_training_table(good)


@pytest.mark.parametrize("bad", ["1::2::3", "1::2::3::4::5", "x::2::3::4", None])
def test_strict_ratings_fail_whatever_is_read(spark, bad):
    df = RS.parse_rating_lines(lines(spark, ["1::2::3.5::978300760", bad]))
    for read in (df.count, df.select("item").collect, df.select("user", "ts").collect, df.collect):
        with pytest.raises(Exception, match="rating line"):
            read()


def test_strict_labeled_fail_whatever_is_read(spark):
    df = LB.parse_labeled_lines(lines(spark, ["1,17,0.5 3", "0,b,x 1"]))
    for read in (df.count, df.select("features").collect, df.select("tag").collect):
        with pytest.raises(Exception, match="labeled line"):
            read()
    assert LB.parse_labeled_lines(lines(spark, ["1,17,0.5 3"])).count() == 1


def test_labeled_text_files(spark, tmp_dir):
    with open(f"{tmp_dir}/train.txt", "w") as f:
        f.write("1,17,0.5 3\n0,4,1 2\n")
    assert LB.read_labeled_text(spark, f"{tmp_dir}/train.txt").count() == 2
    good, bad = LB.read_labeled_text(spark, f"{tmp_dir}/train.txt", strict=False)
    assert (good.count(), bad.count()) == (2, 0)


def test_checks(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "features array<double>")
    with pytest.raises(ValueError, match="dimension"):
        K.require_training_table(df.selectExpr("0.0D AS label", "features"))
    row = K.dimensions(df).first()
    assert (row.min_dim, row.max_dim) == (1, 2)
    b = spark.createDataFrame([([1.0, 200.0],), ([1.5],), ([3.0],)], "features array<double>")
    assert K.byte_violations(b).count() == 2
    n = spark.createDataFrame([([1.0, None],), (None,), ([3.0, 4.0],), ([5.0, 6.0],), ([7.0],)], "features array<double>")
    assert K.byte_violations(n).count() == 2
    faults = [r.fault for r in K.vector_violations(n, byte=True).collect()]
    assert sorted(faults) == ["length", "null element", "null vector"]


def test_csv_files_good_and_bad(spark, tmp_dir):
    from tessera.sources.ratings import scan_rating_csv
    lines = ["1,2,3.5,100", "1,2,x,100", "1,2,3.5", "1,2,3.5,100,9", "7,8,1.0,abc", "9,9,2.0,"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_dir}/feed")
    good, bad = scan_rating_csv(spark, f"{tmp_dir}/feed")
    assert sorted(r.userid for r in good.select("userid").collect()) == [1, 7, 9]
    assert sorted(r.line for r in bad.collect()) == sorted(lines[1:4])
    assert good.count() == 3 and bad.count() == 3
