"""Hilbert shards."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import sharding as S
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 4), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = S.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(rows, n, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("n", [0, 1, 5, 203])
def test_counts_and_slots(spark, n):
    rows = [(i if i % 13 else None, None if i % 5 == 0 else "same text" if i % 2 else "é" * i, ["en", None, "de"][i % 3], "hot" if i % 2 else f"s{i}", i * 7 % 50, 1)
            for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, slot int")
    got = S.shard_documents(df).collect()
    check(got, n, 8)
    assert sorted(r.size for r in got) == sorted(len((r[1] or "").encode()) + 1 for r in rows)


def test_runs_prune(spark):
    df = spark.range(4096).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text", "CAST(id % 8 AS STRING) AS lang",
                                      "CONCAT('s', id DIV 8 % 8) AS source", "id DIV 64 AS n_chars")
    ranked, total = S.hilbert_ranked(df, ["lang", "source", "n_chars"], ["doc_id"])
    r = S.cut(ranked, total, 64).groupBy("shard").agg({"lang": "approx_count_distinct", "source": "approx_count_distinct"}).collect()
    assert sum(x[1] * x[2] for x in r) / len(r) < 32            # of the 64 pairs of values that a random shard holds


def test_runs_prune_sources_with_a_common_prefix(spark):
    df = spark.range(4096).selectExpr("id AS doc_id", "CONCAT('language_', id % 8) AS lang",
                                      "CONCAT('https://host.example/crawl/', id DIV 8 % 8) AS source", "id DIV 64 AS n_chars")
    ranked, total = S.hilbert_ranked(df, ["lang", "source", "n_chars"], ["doc_id"])
    held = defaultdict(set)
    for r in S.cut(ranked, total, 64).collect():
        held[r.shard].add((r.lang, r.source))
    assert sum(len({a for a, _ in v}) * len({b for _, b in v}) for v in held.values()) / len(held) < 32


def test_cells_of_texts_are_shares_of_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "_RUN", 3)
    values = ["", "same prefix a", "same prefix b", "same prefix b\0", "same prefix é", "same prefix \U0001f600", "z" * 5000]
    rows = [(v,) for k, v in enumerate(values) for _ in range((3, 1, 40, 2, 5, 9, 4)[k])] + [(None,)] * 7
    df, _ = S.curve_column(spark.createDataFrame(rows, "d string").repartition(5), ["d"], 3)
    known = sorted(r[0].encode() for r in rows if r[0] is not None)
    bounds = {known[-(-k * len(known) // 8) - 1] for k in range(1, 8)}
    for r in df.collect():
        assert list(r["__cells"]) == [0 if r.d is None else sum(r.d.encode() > b for b in bounds)]


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = S.op8_hilbert_sharding(spark, SF_SMALL).collect()
    check(got, len(docs), 8)
    for r in got:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def plain_shards(docs, shards=8, bits=4):
    """{doc_id: (shard, slot)} by sorting all rows: quantile cells, curve index, checksum, id, size."""
    cells = []
    for name in ("lang", "source", "n_chars"):
        of = lambda v: v.encode() if isinstance(v, str) else v
        known = sorted(of(d[name]) for d in docs if d[name] is not None)
        bounds = {known[-(-k * len(known) // (1 << bits)) - 1] for k in range(1, 1 << bits)} if known else set()
        cells.append([0 if d[name] is None else sum(of(d[name]) > b for b in bounds) for d in docs])
    curve = S.hilbert_index(np.array(cells).T, bits)
    first = lambda v: (v is not None, v if v is not None else 0)
    order = sorted(range(len(docs)), key=lambda i: (
        curve[i], first(None if docs[i]["text"] is None else zlib.crc32(docs[i]["text"].encode())), first(docs[i]["doc_id"]), len((docs[i]["text"] or "").encode())))
    out, at = {}, 0
    for shard in range(shards):
        size = len(docs) // shards + (shard < len(docs) % shards)
        out |= {docs[i]["doc_id"]: (shard, slot) for slot, i in enumerate(order[at:at + size])}
        at += size
    return out


def test_query_equals_a_plain_sort(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.shard, r.slot) for r in S.op8_hilbert_sharding(spark, SF_SMALL).collect()}
    assert got == plain_shards(docs)
