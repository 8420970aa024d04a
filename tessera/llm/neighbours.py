"""Approximate nearest neighbours by inner product: a forest of hash strings.

Every tree gives a vector a string of BITS bits: the sides of as many random hyperplanes
through the mean of all rows, so near vectors share long prefixes.  Inner products become
angles by one more component: vectors get sqrt(M^2 - |x|^2), M the largest norm, queries 0.

The trees' strings in order are sorted arrays; behind a byte for the tree they are one array,
range partitioned and sorted, with places 0, 1, 2, ... written beside the rows.  It is cut into
blocks of BLOCK places, longer ones beyond DIRECTORY blocks, and the first and last string of
every block are the directory (at most DIRECTORY + 1 entries, about 2 MB).  A query descends
in each tree to its place in the array: the rows that share a prefix of any length with it are
a range of places around it, found exactly inside its own block and through the directory
beyond (there rounded up to whole blocks, which adds candidates).  It then ascends in all trees
at the same time, one bit a step, until the ranges hold at least `need` candidates together
(a row counts once per tree).  All rows of those ranges are scored, in double precision.

How many candidates recall needs is a property of the data: few where there are clusters, a
share of all rows where there are none.  So `need` is fitted: SAMPLE queries (all, if fewer),
taken by a hash of the id, are answered exactly over all rows, and `need` is the smallest
number with which the ascent finds RECALL of their neighbours, but LEAST at least.  Nothing
else depends on the size of the table: a small one is scored whole only if the ascent gets there.

Tasks are (block, part of its queries): at most PART queries meet a block at a time, so a
region that holds a third of the rows or queries is many tasks.  A task keeps the k + 1 best
of its block per query.  Equal vectors are indexed once: the index knows their k + 1 smallest
ids, which is all that a result of k can hold, and equal queries are searched once.

Defined cases.  Vectors that are null, all zero, or hold nulls or numbers that are not finite
take no part, neither do those whose length isn't the table's most common one (of equally
common ones the greatest).  Null ids take no part.  Ties go to the smaller id.  With fewer
than k candidates all are returned.  Columns other than id and vector are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.split import with_row_id
from tessera.session import scratch_path

TREES = 16
BITS = 128
BLOCK = 1024
DIRECTORY = 1 << 16
PART = 4096
LEAST = 4000
SAMPLE = 256
RECALL = 0.95
SEED = 7
_BYTES = 1 + BITS // 8             # the tree's number stands before the string
_CELLS = 4 << 20                   # scores held at a time
_RESULT = "query_id long, rank int, vec_id long, score double"
_FOUND = pa.schema([("qid", pa.int64()), ("vid", pa.int64()), ("score", pa.float64())])


def _matrix(col: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.chunked_array([col]) if isinstance(col, pa.Array) else col
    return np.concatenate([np.zeros(0), *[c.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in flat.chunks]]).reshape(-1, dim)


def _on_sphere(x: np.ndarray, norm: float, query: bool) -> np.ndarray:
    last = np.zeros(len(x)) if query else np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))
    return np.column_stack((x, last))


def hash_strings(x: np.ndarray, centre: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """Rows x trees x bytes: the tree's number, then its string."""
    rng = np.random.default_rng(seed)
    out = np.empty((len(x), trees, _BYTES), np.uint8)
    for t in range(trees):
        planes = rng.standard_normal((x.shape[1], BITS))
        out[:, t, 0] = t
        out[:, t, 1:] = np.packbits((x - centre) @ planes > 0, axis=1)
    return out


def shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of strings (bytes in the last axis, without the tree's number)."""
    differ = np.unpackbits(a ^ b, axis=-1)
    return np.where(differ.any(axis=-1), differ.argmax(axis=-1), BITS)


def _binary_lists(s: np.ndarray) -> pa.Array:
    n, trees = s.shape[:2]
    flat = pa.Array.from_buffers(pa.binary(), n * trees, [None, pa.py_buffer(np.arange(0, (n * trees + 1) * _BYTES, _BYTES, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(s))])
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * trees), flat)


def _sums(dim: int, norm: float):
    def run(batches):
        total = np.zeros(dim + 1)
        for b in batches:
            total += _on_sphere(_matrix(b.column(0), dim), norm, False).sum(axis=0)
        yield pa.record_batch({"j": pa.array(np.arange(dim + 1)), "s": pa.array(total)})
    return run


def _strings(dim: int, norm: float, centre: np.ndarray, trees: int, seed: int):
    def run(batches):
        for b in batches:
            x = _matrix(b.column(1), dim)
            each = {name: _binary_lists(hash_strings(_on_sphere(x, norm, query), centre, trees, seed)) for name, query in (("strings", False), ("asked", True))}
            yield pa.record_batch({"vid": b.column(0), "vector": b.column(1), "asks": b.column(2), **each})
    return run


def _keys(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, _BYTES)


def _ordered(keys: np.ndarray) -> np.ndarray:
    """The same as byte strings that numpy compares (all of one length, so trailing zeros do no harm)."""
    return np.ascontiguousarray(keys).view(f"S{_BYTES}").ravel()


@dataclass
class Forest:
    """The index: rows with their strings, the sorted arrays, and the directory of their blocks."""

    rows: DataFrame            # vid, vector, asks, strings, asked
    arrays: DataFrame          # key, vid, pos, block
    first: np.ndarray
    last: np.ndarray
    size: int                  # places of a block
    n: int
    dim: int
    trees: int
    base: str


def build(one: DataFrame, n: int, dim: int, norm: float, base: str, trees: int = TREES, block: int = BLOCK, seed: int = SEED) -> Forest:
    """Indexes (vid, vector, asks); the vectors are different and of one length."""
    spark = one.sparkSession
    sums = {r["j"]: r["s"] for r in one.select("vector").mapInArrow(_sums(dim, norm), "j long, s double").groupBy("j").agg(F.sum("s").alias("s")).collect()}
    centre = np.round(np.array([sums[j] for j in range(dim + 1)]) / n, 6)
    kind = one.schema["vector"].dataType.simpleString()
    one.select("vid", "vector", "asks").mapInArrow(_strings(dim, norm, centre, trees, seed),
                                                   f"vid long, vector {kind}, asks boolean, strings array<binary>, asked array<binary>").write.parquet(f"{base}/strings")
    rows = spark.read.parquet(f"{base}/strings")
    size = max(block, -(-n * trees // DIRECTORY))
    with_row_id(rows.select("vid", F.explode("strings").alias("key")), ["key", "vid"], "pos") \
        .withColumn("block", F.expr(f"cast(pos div {size} as int)")).write.parquet(f"{base}/arrays")
    arrays = spark.read.parquet(f"{base}/arrays")
    ends = arrays.groupBy("block").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("block").collect()      # at most DIRECTORY + 1 rows
    first, last = (_ordered(np.frombuffer(b"".join(bytes(r[c]) for r in ends), np.uint8).reshape(-1, _BYTES)) for c in ("first", "last"))
    return Forest(rows, arrays, first, last, size, n, dim, trees, base)


def _homes(first: np.ndarray):
    def run(batches):
        for b in batches:
            home = np.maximum(np.searchsorted(first, _ordered(_keys(b.column(1))), "right") - 1, 0)
            yield pa.record_batch({"qid": b.column(0), "key": b.column(1), "block": pa.array(home.astype(np.int32))})
    return run


def _met(queries: DataFrame, rows: DataFrame, per: int):
    """A block's queries, in parts of about `per`, beside its rows."""
    parts = F.broadcast(queries.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / per).cast("int").alias("parts")))       # a row per block of the directory
    q = queries.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("qid"), "parts").cast("int")).drop("parts")
    r = rows.join(parts, "block").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
    return q.groupBy("block", "part").cogroup(r.groupBy("block", "part"))


_RANGES = pa.schema([("qid", pa.int64()), ("tree", pa.int32()), ("level", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("more", pa.int64())])


def _ranges(forest_first: np.ndarray, forest_last: np.ndarray, size: int, n: int):
    """Per query and tree, the range of places of every prefix length at which it grows."""
    first, last = forest_first, forest_last
    mask = np.zeros((BITS + 1, _BYTES), np.uint8)
    mask[:, 0] = 255
    mask[:, 1:] = np.packbits(np.arange(BITS) < np.arange(BITS + 1)[:, None], axis=1)

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return _RANGES.empty_table()
        place = rows["pos"].to_numpy()
        order = np.argsort(place)
        keys, start, home = _ordered(_keys(rows["key"])[order]), int(place.min()), queries["block"][0].as_py()
        names, asked = queries["qid"].to_numpy(), _keys(queries["key"])
        out = []
        for at in range(0, len(names), 512):
            q = asked[at:at + 512]
            low, high = _ordered((q[:, None] & mask).reshape(-1, _BYTES)), _ordered((q[:, None] | ~mask).reshape(-1, _BYTES))
            # Inside the block, or else where the directory says that the range begins and ends.
            b = np.searchsorted(first, low, "left") - 1
            outer = np.where(b < 0, 0, np.where(last[b] < low, b + 1, b)) * size
            lo = np.where(first[home] < low, start + np.searchsorted(keys, low, "left"), outer)
            hi = np.where(last[home] > high, start + np.searchsorted(keys, high, "right"), np.searchsorted(first, high, "right") * size)
            tree = np.repeat(q[:, 0].astype(np.int64), BITS + 1)
            lo, hi = (np.clip(p, tree * n, tree * n + n).reshape(len(q), -1) for p in (lo, hi))
            length = np.maximum(hi - lo, 0)
            more = length.copy()
            more[:, :-1] -= length[:, 1:]
            i, level = np.nonzero(more > 0)
            out.append(pa.table([names[at + i], q[i, 0].astype(np.int32), level.astype(np.int32), lo[i, level], hi[i, level], more[i, level]], schema=_RANGES))
        return pa.concat_tables(out)
    return run


def descend(forest: Forest) -> DataFrame:
    """(qid, tree, level, lo, hi, more): the ranges around every query, `more` rows longer than at the next level down."""
    asked = forest.rows.where("asks").select(F.col("vid").alias("qid"), F.explode("asked").alias("key")).mapInArrow(_homes(forest.first), "qid long, key binary, block int")
    _met(asked, forest.arrays.select("key", "pos", "block"), PART).applyInArrow(
        _ranges(forest.first, forest.last, forest.size, forest.n), "qid long, tree int, level int, lo long, hi long, more long").write.parquet(f"{forest.base}/ranges")
    return asked.sparkSession.read.parquet(f"{forest.base}/ranges")


def candidates(ranges: DataFrame) -> DataFrame:
    """(qid, level, held): rows that the ranges of all trees hold together, per prefix length at which one grows."""
    each = ranges.groupBy("qid", "level").agg(F.sum("more").alias("more"))
    return each.select("qid", "level", F.sum("more").over(Window.partitionBy("qid").orderBy(F.desc("level"))).alias("held"))


def _exact(names: np.ndarray, asked: np.ndarray, k: int):
    """The k best rows of a task for every sampled query, itself left out."""
    def run(batches):
        score, vid = np.full((len(names), k), -np.inf), np.zeros((len(names), k), np.int64)
        for b in batches:
            ids = b.column(0).to_numpy()
            s = asked @ _matrix(b.column(1), asked.shape[1]).T
            s[names[:, None] == ids] = -np.inf
            s, ids = np.concatenate((score, s), axis=1), np.concatenate((vid, np.broadcast_to(ids, s.shape)), axis=1)
            best = np.argpartition(-s, k - 1, axis=1)[:, :k]
            score, vid = np.take_along_axis(s, best, 1), np.take_along_axis(ids, best, 1)
        i, j = np.nonzero(score > -np.inf)
        yield pa.record_batch([pa.array(names[i]), pa.array(vid[i, j]), pa.array(score[i, j])], schema=_FOUND)
    return run


def fit_need(forest: Forest, ranges: DataFrame, k: int, sample: int = SAMPLE, recall: float = RECALL) -> int:
    """Candidates a query needs so that the ascent finds `recall` of the k nearest of the sampled queries."""
    picked = forest.rows.where("asks").select("vid", "vector", "asked").orderBy(F.xxhash64("vid"), "vid").limit(sample).collect()
    if not picked:
        return 1
    names = np.array([r["vid"] for r in picked])
    vectors = np.array([r["vector"] for r in picked], np.float64)
    asked = np.stack([_keys(pa.array([bytes(a) for a in r["asked"]]))[:, 1:] for r in picked])
    near = forest.rows.select("vid", "vector").mapInArrow(_exact(names, vectors, k), "qid long, vid long, score double")
    near = near.withColumn("nth", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vid"))).where(f"nth <= {k}").select("qid", "vid")
    hits = {int(q): [] for q in names}
    where = {int(q): i for i, q in enumerate(names)}
    for r in near.join(forest.rows.select("vid", "strings"), "vid").select("qid", "strings").collect():          # at most sample * k rows
        own = _keys(pa.array([bytes(a) for a in r["strings"]]))[:, 1:]
        hits[r["qid"]].append(int(shared_bits(asked[where[r["qid"]]], own).max()))
    steps = {int(q): [] for q in names}
    for r in candidates(ranges.where(F.col("qid").isin([int(q) for q in names]))).collect():                     # at most sample * (BITS + 1) rows
        steps[r["qid"]].append((r["held"], r["level"]))
    steps = {q: sorted(s) for q, s in steps.items()}
    total = sum(map(len, hits.values()))

    def found(need: int) -> int:
        level = {q: next((lv for held, lv in s if held >= need), 0) for q, s in steps.items()}
        return sum(h >= level[q] for q, hs in hits.items() for h in hs)

    tried = sorted({held for s in steps.values() for held, _ in s})
    low, high = 0, len(tried) - 1
    while low < high:                                            # more candidates never find fewer neighbours
        mid = (low + high) // 2
        low, high = (low, mid) if found(tried[mid]) >= recall * total else (mid + 1, high)
    return max(tried[low], k + 1)


def ascend(forest: Forest, ranges: DataFrame, need: int) -> DataFrame:
    """(qid, tree, lo, hi): the ranges at the longest prefix with which they hold `need` rows together, or all rows of a tree."""
    held = candidates(ranges)
    stop = held.groupBy("qid").agg(F.coalesce(F.max(F.when(F.col("held") >= need, F.col("level"))), F.lit(0)).alias("stop"))
    at = ranges.join(stop, "qid").where("level >= stop").groupBy("qid", "tree").agg(F.min_by(F.struct("lo", "hi"), "level").alias("at")).select("qid", "tree", "at.*")
    whole = F.min(F.when(F.col("hi") - F.col("lo") == forest.n, F.col("tree"))).over(Window.partitionBy("qid"))
    return at.withColumn("whole", whole).where("whole IS NULL OR tree = whole").drop("whole")                    # one tree holds all rows


def _best(k: int, dim: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return _FOUND.empty_table()
        place = rows["pos"].to_numpy()
        order = np.argsort(place)
        place, ids, x = place[order], rows["vid"].to_numpy()[order], _matrix(rows["vector"], dim)[order]
        lo, hi = np.searchsorted(place, queries["lo"].to_numpy()), np.searchsorted(place, queries["hi"].to_numpy())
        names, y, by_place = queries["qid"].to_numpy(), _matrix(queries["vector"], dim), np.argsort(lo, kind="stable")
        step, out = max(1, min(256, _CELLS // len(x))), []
        for i in range(0, len(names), step):
            some = by_place[i:i + step]
            a, b = lo[some].min(), hi[some].max()
            s, at = y[some] @ x[a:b].T, np.arange(a, b)
            s[(at < lo[some, None]) | (at >= hi[some, None])] = -np.inf
            floor = np.partition(s, s.shape[1] - k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
            q, r = np.nonzero((s >= floor[:, None]) & (s > -np.inf))
            best = np.lexsort((ids[a + r], -s[q, r], q))
            q, r = q[best], r[best]
            keep = np.arange(len(q)) - np.searchsorted(q, q) < k
            q, r = q[keep], r[keep]
            out.append(pa.table([names[some[q]], ids[a + r], s[q, r]], schema=_FOUND))
        return pa.concat_tables(out)
    return run


def score(forest: Forest, chosen: DataFrame, k: int) -> DataFrame:
    """(qid, vid, score): the k best rows of every block in a query's ranges."""
    stored = forest.rows.sparkSession.read.parquet(f"{forest.base}/strings")            # apart from the queries' vectors, for the analyser
    rows = forest.arrays.select("vid", "pos", "block").join(stored.select("vid", "vector"), "vid")
    queries = chosen.join(forest.rows.where("asks").select(F.col("vid").alias("qid"), "vector"), "qid") \
        .select("qid", "vector", "lo", "hi", F.explode(F.expr(f"sequence(cast(lo div {forest.size} as int), cast((hi - 1) div {forest.size} as int))")).alias("block"))
    return _met(queries, rows, PART).applyInArrow(_best(k, forest.dim), "qid long, vid long, score double")


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES,
           least: int = LEAST, need: int | None = None, recall: float = RECALL, sample: int = SAMPLE, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best found for every row for which `is_query` holds.

    `need` candidates are scored for each; if not given, as many as `recall` over `sample` queries takes, and at least `least`.
    """
    spark = vectors.sparkSession
    base = scratch_path(spark, "neighbours")
    v = F.col("vector")
    good = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asks"))
            .where("id IS NOT NULL AND vector IS NOT NULL")
            .where(~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists(v, lambda e: e != 0)))
    sizes = good.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], _RESULT)
    dim = sizes["d"]
    good = good.where(F.size("vector") == dim)

    # Equal vectors are one: named by their smallest id.
    good.groupBy("vector").agg(F.min("id").alias("vid"), F.max(F.coalesce("asks", F.lit(False))).alias("asks")).write.parquet(f"{base}/vectors")
    one = spark.read.parquet(f"{base}/vectors")
    norm, n = one.agg(F.sqrt(F.max(F.aggregate("vector", F.lit(0.0), lambda a, e: a + e.cast("double") * e))), F.count(F.lit(1))).first()
    forest = build(one, n, dim, norm, base, trees, block, seed)
    ranges = descend(forest)
    need = max(least, fit_need(forest, ranges, k, sample, recall)) if need is None else need
    ascend(forest, ranges, min(need, n * trees)).write.parquet(f"{base}/chosen")
    found = score(forest, spark.read.parquet(f"{base}/chosen"), k + 1)

    by_score = Window.partitionBy("qid").orderBy(F.desc("score"), "vid")
    found = found.groupBy("qid", "vid").agg(F.max("score").alias("score")).withColumn("nth", F.row_number().over(by_score)).where(f"nth <= {k + 1}")
    # From vectors back to rows: k + 1 ids of a vector are enough; every query gets its vector's list, without itself.
    vid_of = good.join(one.select("vid", "vector"), "vector").select("id", "vid", "asks")
    ids = vid_of.withColumn("nth", F.row_number().over(Window.partitionBy("vid").orderBy("id"))).where(f"nth <= {k + 1}").select("vid", "id")
    near = found.select("qid", "vid", "score").join(ids, "vid").select("qid", "id", "score")
    queries = vid_of.where("asks").select(F.col("id").alias("query_id"), F.col("vid").alias("qid"))
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    # A vector's list is cut to what its queries can need before it is handed to each of them.
    short = near.withColumn("nth", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "id"))).where(f"nth <= {k + 1}").drop("nth")
    return (queries.join(short, "qid").where("query_id <> id").withColumn("rank", F.row_number().over(first)).where(f"rank <= {k}")
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"))


def op7_hash_forest_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every 20th id; candidates: all other rows; 20 nearest."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, k=20)
