"""The manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle as M
from tests.conftest import SF_SMALL
from tests.llm import plain
from tests.oracle_check import compare, duck

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(hashes: list[str]):
    """(root, [[(left, right) of each level] of each leaf])."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for k, i in enumerate(at):
            lo = i // 16 * 16
            paths[k].append(("".join(level[lo:i]), "".join(level[i + 1:lo + 16])))
        level = [H(*level[lo:lo + 16]) for lo in range(0, len(level), 16)]
        at = [i // 16 for i in at]
    return level[0], paths


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    """rows: (doc_id, source, lang, n_chars, text)."""
    first = lambda v: (v is not None, v if v is not None else 0)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (first(r[0]), leaf(r)))
        trees[s] = (mine, *climb([leaf(r) for r in mine]))
    root, tops = climb([trees[s][1] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        mine, subroot, paths = trees[s]
        for r, path in zip(mine, paths):
            path = path + top
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            h = leaf((*r[:4], None if r[4] is None else plain.fold(r[4]))) if changed else leaf(r)
            for left, right in path:
                h = H(left, h, right)
            out.append((r[0], leaf(r), subroot, root, H(*(x for p in path for x in p)), h, h == root))
    return out


def result(df):
    out = df.withColumn("start", F.coalesce("other", "leaf")).withColumn("end", M.folded("start", "path"))
    return [tuple(r) for r in out.select("id", *[F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")], M.proof("path"),
                                         F.lower(F.hex("end")), F.col("end") == F.col("root")).collect()]


def key(r):
    return tuple(str(v) for v in r)


def manifest(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, path string, g string")
    changed = M.leaf_digest([M.folded_case(F.col(f)) if f == "text" else F.col(f) for f in FIELDS])
    return M.manifest(df, "source", "doc_id", FIELDS, F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, changed))


@pytest.mark.parametrize("sources", [1, 3, 40])
def test_equals_a_plain_tree(spark, sources):
    rnd = random.Random(sources)
    names = [None, "", "a", "A", "é", "z"][:sources] + [f"s{i}" for i in range(max(0, sources - 6))]
    rows = [(i, rnd.choice(names) if i > 300 else names[-1], rnd.choice(["de", None]), i % 7 or None, rnd.choice([None, "", "Text É", "plain text"])) for i in range(700)]
    rows += [rows[5], rows[5], (None, names[0], None, None, "null id"), (None, names[0], None, None, "Another"), (3, "alone", "x", 1, "One Row")]
    assert sorted(result(manifest(spark, rows)), key=key) == sorted(plain_manifest(rows), key=key)


def test_one_row_and_none(spark):
    rows = [(10, "s", "x", 1, "Alone")]
    got = result(manifest(spark, rows))
    assert got == plain_manifest(rows) and got[0][1] == got[0][3] and got[0][4] == H("")
    df = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert M.manifest(df, "source", "doc_id", FIELDS).count() == 0


def test_query_equals_the_plain_tree_and_sql(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*FIELDS).collect()
    got = [tuple(r) for r in M.op13_merkle_manifest(spark, SF_SMALL).collect()]
    assert sorted(got, key=key) == sorted(plain_manifest([tuple(r) for r in docs]), key=key)
    ok, message, _, _ = compare(spark, duck(SF_SMALL), "op13_merkle_manifest", M.op13_merkle_manifest, M.ORACLE, SF_SMALL)
    assert ok, message
