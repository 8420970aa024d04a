"""The pipeline's stages against plain versions, on the smallest tables and on odd rows."""

from collections import Counter

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tests.llm import plain

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = {}
    for name, stage in P.STAGES:
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        rows[name] = (before, docs.collect(), docs.columns)
    for name in ("toxicity", "near_dedup", "decontamination", "mixing"):
        assert rows[name][2] == COLUMNS
    for name in ("toxicity", "near_dedup", "decontamination"):
        before, after, _ = rows[name]
        assert set(map(tuple, after)) <= set(before)
    before, after, _ = rows["near_dedup"]
    groups = plain.groups([(r[0], r[1]) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(set(groups.values()))
    before, after, _ = rows["decontamination"]
    assert sorted(r.doc_id for r in after) == sorted(r[0] for r in before if not plain.contamination(r[1], items)[1])
    before, after, _ = rows["mixing"]
    sizes = Counter()
    for r in before:
        sizes[r[3]] += len(plain.space_words(r[1]))
    taken = Counter()
    for r in after:
        taken[r.source] += len(plain.space_words(r.text))
    assert all(abs(taken[s] - t) <= 1 for s, t in plain.targets(sizes).items())
    before, after, _ = rows["sharding"]
    assert Counter(before) == Counter(tuple(r[c] for c in COLUMNS) for r in after)
    shards = Counter(r.shard for r in after)
    assert max(shards.values()) - min(shards.values()) <= 1 and len(shards) == 8


def test_run_on_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "some words here", "en", "a", 15), (3, "some words here", "en", "a", 15), (None, "nameless row", "de", "b", 12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = P.run(spark, str(tmp_path)).collect()
    assert sum(len(r.text.split()) for r in out) == 7              # 1.5 times the five words left, rounded down per source
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/none/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert P.run(spark, f"{tmp_path}/none").count() == 0


def test_sharding_keeps_columns_of_its_own_names(spark):
    rows = [(i, f"text {i}", "en", "a", 6, f"r{i}", i * 10, -1, "s") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rank string, curve long, shard int, slot string")
    out = P.sharded(spark, df, SF_SMALL)
    assert out.columns == [*df.columns, "curve_", "shard_", "slot_"]
    assert sorted(tuple(r)[:9] for r in out.collect()) == rows
    assert Counter(r.shard_ for r in out.collect()) == Counter({s: 3 if s < 4 else 2 for s in range(8)})
