"""Near-duplicate groups by circulant MinHash, confirmed on full shingle sets.

A document's set holds the hashes of its distinct runs of `shingle` words (fewer words:
the whole sequence is the only element).  Two documents are linked if
100 * |intersection| >= percent * |union|; groups are the components of the links.

Signature.  Elements live on a circle of 2^32 places.  One permutation (sigma) spreads
them, a second one (pi) orders the places; coordinate k is the smallest pi(sigma(x) - k),
so a single pi, shifted circularly, serves all coordinates.  Bands of r coordinates make
bucket keys; r and the number of bands follow from the threshold so that a pair exactly at
it is missed by every band with a probability of at most MISS.

Work, in order:

1. equal sets become one node (the smallest document id), so exact copies cost one row;
2. buckets with several nodes are found by an aggregation over keys alone;
3. stars: every node of a bucket is confirmed against one pivot of it, first the node that
   shares the most buckets with others, the centre of a group of near copies.  That is linear
   in the bucket and pulls large groups into few components; it is repeated with another
   pivot where a bucket still holds several components;
4. rest: nodes that are still in different components are compared by a prefix-filtered join,
   so no link that joins two components is lost to the stars.  The first star has found the
   elements by which each node differs from the pivot.  Two linked nodes of one pivot must
   have some of these differences in common, how many follows from the sizes; so differences
   are ordered by rarity, and only nodes that share one of their necessary rare ones meet,
   with a bound on what can still follow.  Altered copies of one text that were altered in
   different places never meet, however many there are.

Only pairs that the exact length bound and a 256-bit sketch of the signature allow are
confirmed: the join condition compares two bits of each of 128 coordinates and passes a
pair at the threshold but for a probability of about 1e-7.  Confirmation recomputes the
full sets from the two texts.  Components are found by repeated minimum labels over tables
written to the checkpoint folder.  Nothing about all documents reaches the driver.

Defined cases.  Null, empty or blank texts have an empty set (size 0), are linked with
nothing and kept.  Rows with a null id are kept, with a null component.  Rows that repeat
an id are one node of the graph: what is linked with one of them is linked with all, and
`keep_one` keeps the first of them by text.  Columns other than id and text are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import tokens as T
from tessera.llm.bitset import where_marked
from tessera.session import scratch_path

COORDINATES = 128
MISS = 1e-6
STAR_ROUNDS = 2
#: Of 128; 96 are expected of unrelated sets.
FIRST_DIFFERENCES = 64
_SKETCH_SIGMAS = 5.6


def bands_for(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> tuple[int, int]:
    """(rows, bands): the longest bands of which enough fit into the coordinates."""
    j = percent / 100
    for rows in range(16, 0, -1):
        hit = j ** rows
        bands = 1 if hit >= 1 else math.ceil(math.log(miss) / math.log1p(-hit))
        if rows * bands <= coordinates:
            return rows, bands
    raise ValueError("no banding reaches this recall")


def sketch_bound(percent: int) -> int:
    """Most coordinates whose two bits may differ for a pair that is confirmed."""
    p = 0.75 * percent / 100 + 0.25
    return math.ceil(COORDINATES * (1 - p) + _SKETCH_SIGMAS * math.sqrt(COORDINATES * p * (1 - p)))


def shingle_sets(col: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles, ordered by row and hash."""
    w = T.Words(col, T.word_table(T.SPACE_SEPARATORS))
    at, h = w.grams(n)
    doc = [w.doc[at]]
    hashes = [h]
    for short in range(1, n):
        rows = np.flatnonzero(w.count == short)
        doc.append(rows)
        hashes.append(T.sequence_hash(w.hash, w.first[rows], short))
    doc, h = np.concatenate(doc), np.concatenate(hashes)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def _mix32(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of 32-bit integers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signatures(doc: np.ndarray, h: np.ndarray, coordinates: int = COORDINATES, step: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have elements, and their circulant MinHash coordinates."""
    starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else np.empty(0, np.int64)
    out = np.empty((coordinates, len(starts)), np.uint32)
    place = _mix32((h ^ (h >> np.uint64(32))).astype(np.uint32), 0x7FEB352D, 0x846CA68B)     # sigma
    lo = 0
    while lo < len(starts):                      # whole rows, about `step` elements at a time: they stay in cache
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + step)))
        a, b = starts[lo], starts[hi] if hi < len(starts) else len(h)
        cut = starts[lo:hi] - a
        for k in range(coordinates):
            out[k, lo:hi] = np.minimum.reduceat(_mix32(place[a:b] - np.uint32(k), 0x21F0AAAD, 0xD35A2D97), cut)   # pi, shifted
        lo = hi
    return doc[starts], out


def _sign(n: int, rows: int, bands: int):
    def run(batches):
        for part in T.chunks(batches):
            size = part.num_rows
            doc, h = shingle_sets(part.column(1), n)
            count = np.bincount(doc, minlength=size)
            have, sig = signatures(doc, h)
            keys = np.zeros((size, bands), np.uint64)
            for b in range(bands):
                key = np.full(len(have), b + 1, np.uint64)
                for k in range(rows):
                    key = T.mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig[b * rows + k].astype(np.uint64))
                keys[have, b] = key
            sketch = np.zeros((size, 4), np.uint64)
            for k in range(COORDINATES):
                sketch[have, k // 32] |= (sig[k] & np.uint32(3)).astype(np.uint64) << np.uint64(2 * (k % 32))
            ends = np.cumsum(count)
            whole = np.zeros((size, 2), np.uint64)     # sums of two mixes of the elements name the set
            for i, m in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(T.mix64(h * np.uint64(m) + np.uint64(i)))))
                whole[:, i] = sums[ends] - sums[ends - count]
            yield pa.record_batch(
                {"id": part.column(0), "n": pa.array(count.astype(np.int64)), "set1": T.signed(whole[:, 0].copy()), "set2": T.signed(whole[:, 1].copy()),
                 **{f"s{i}": T.signed(sketch[:, i].copy()) for i in range(4)},
                 "keys": pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * bands), T.signed(keys.ravel()))})
    return run


_PLACES = ["n", "s0", "s1", "s2", "s3"]


def _near(percent: int, differences: int) -> str:
    """Length bound and sketch of a pair of sides a, b, of at most so many differences."""
    differ = " + ".join(f"bit_count(((a.s{i} ^ b.s{i}) | shiftrightunsigned(a.s{i} ^ b.s{i}, 1)) & 6148914691236517205L)" for i in range(4))
    return (f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) AND {differ} <= {differences}")


def _confirm(n: int, percent: int):
    """Whether the sets of text_a and text_b are linked, the size of a's, and the elements that only one of them has."""
    def run(batches):
        for part in T.chunks(batches, "text_a", T.CHUNK_BYTES // 2):
            names = part.schema.names
            size = part.num_rows
            (da, ha), (db, hb) = (shingle_sets(part.column(names.index(side)), n) for side in ("text_a", "text_b"))
            na, nb = np.bincount(da, minlength=size), np.bincount(db, minlength=size)
            d, h = np.concatenate((da, db)), np.concatenate((ha, hb))
            order = np.lexsort((h, d))
            d, h = d[order], h[order]
            both = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
            common = np.bincount(d[1:][both], minlength=size)
            alone = np.ones(len(d), bool)
            alone[1:] &= ~both
            alone[:-1] &= ~both
            linked = (100 * common >= percent * (na + nb - common)) & (common > 0)
            differ = np.concatenate((np.zeros(1, np.int32), np.cumsum(na + nb - 2 * common, dtype=np.int32)))
            yield pa.record_batch({"a": part.column(names.index("a")), "b": part.column(names.index("b")), "linked": pa.array(linked),
                                   "pivot_n": pa.array(na.astype(np.int64)), "differ": pa.ListArray.from_arrays(pa.array(differ), T.signed(h[alone].copy()))})
    return run


def _share_differences(rest: DataFrame, percent: int, near) -> DataFrame:
    """Pairs (a, b) of different components that may be linked, of nodes with a common pivot: a prefix-filtered join.

    With D the difference of a node's set and the pivot's, linked nodes have |D_a & D_b| >= (|D_a| + |D_b| - r (n_a + n_b)) / 2,
    r = (100 - percent) / (100 + percent).  A node not linked to the pivot has |D| > r (n + n_pivot), any node |D| - r n >= -r n_pivot;
    so each side alone bounds that overlap from below, by 1 at least unless both are linked to the pivot (then they are in
    one component).  Elements are ordered by rarity; of the d elements of D the first d + 1 - bound hold a common one.
    """
    nodes = rest.groupBy("pivot", "id").agg(*[F.first(c).alias(c) for c in ("comp", *_PLACES, "linked", "pivot_n", "differ")])
    nodes = nodes.withColumn("d", F.size("differ"))
    elements = nodes.select("pivot", "id", "comp", "d", F.explode("differ").alias("x"))
    shared = elements.groupBy("pivot", "x").agg(F.count(F.lit(1)).alias("often"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    # Elements of one component only never meet another; they keep their places before all others.
    shared = shared.where("lo <> hi").select("pivot", "x", "often")
    of = Window.partitionBy("pivot", "id")
    placed = elements.select("pivot", "id", "d", "x").join(shared, ["pivot", "x"])
    placed = placed.withColumn("place", F.row_number().over(of.orderBy("often", "x")) + F.col("d") - F.count(F.lit(1)).over(of)).drop("d")
    bound = lambda sign: F.expr(f"greatest(1, (d * {100 + percent} - {100 - percent} * (n {sign} pivot_n) + {2 * (100 + percent) - 1}) div {2 * (100 + percent)})")
    sides = nodes.drop("differ").withColumn("narrow", F.col("d") + 1 - bound("-")).withColumn("wide", F.when(F.col("linked"), F.col("narrow")).otherwise(F.col("d") + 1 - bound("+")))
    tokens = placed.join(sides, ["pivot", "id"]).where("place <= wide")
    r = f"{100 - percent}D / {100 + percent}"
    may = (f"a.comp < b.comp AND ((a.place <= a.narrow AND b.place <= b.narrow) OR a.linked OR b.linked)"
           f" AND 2 * (1 + least(a.d - a.place, b.d - b.place)) >= a.d + b.d - {r} * (a.n + b.n) - 1e-6")
    met = tokens.alias("a").join(tokens.alias("b"), F.expr(f"a.pivot = b.pivot AND a.x = b.x AND {may}") & near)
    return met.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


class _Tables:
    """Tables written to the checkpoint folder: read again they have no lineage, and a lost executor costs nothing finished."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.count = spark, scratch_path(spark, "near-dedup"), 0

    def put(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)


def confirm_pairs(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) with `linked`, by the full sets of their texts, and what else `_confirm` finds."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    used = texts.join(ids, "id", "left_semi")
    side = lambda c: used.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))
    kind = texts.schema["id"].dataType.simpleString()
    return (pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
            .mapInArrow(_confirm(n, percent), f"a {kind}, b {kind}, linked boolean, pivot_n long, differ array<long>"))


def components(tables: _Tables, edges: DataFrame) -> DataFrame:
    """(id, comp): smallest id that the edges (a, b) reach, for the ids that have edges.

    Alternates hooking every label's neighbours to the smallest label around and
    shortening the label chains, until nothing changes: few rounds, whatever the shape.
    """
    both = tables.put(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = tables.put(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("comp")))
    while True:
        around = (both.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("low")))
        hooked = labels.join(around.select(F.col("a").alias("id"), "low"), "id").select("id", F.col("comp").alias("old"), F.least("comp", "low").alias("comp"))
        # the old label's own node learns the new label too
        down = hooked.where("comp < old").groupBy(F.col("old").alias("id")).agg(F.min("comp").alias("down"))
        hooked = tables.put(hooked.join(down, "id", "left").select("id", "old", F.least("comp", "down").alias("comp")))
        jump = hooked.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        new = tables.put(hooked.join(jump, "comp", "left").select("id", "old", F.least("comp", "far").alias("comp")))
        labels = new.select("id", "comp")
        if not new.where("comp <> old").limit(1).count():
            return labels


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 85) -> DataFrame:
    """Per document row: id, n (set size), comp (smallest id reachable), links (confirmed links of its set, as found)."""
    spark = docs.sparkSession
    rows, bands = bands_for(percent)
    tables = _Tables(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = tables.put(texts.mapInArrow(
        _sign(shingle, rows, bands), f"id {kind}, n long, set1 long, set2 long, s0 long, s1 long, s2 long, s3 long, keys array<long>"))
    real = signed.where("n > 0 AND id IS NOT NULL")
    # One node per distinct set: equal sets have equal sketches and keys.
    nodes = tables.put(real.groupBy("set1", "set2", "n").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in (*_PLACES[1:], "keys")]))
    keyed = nodes.select("id", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("key")
    in_buckets = tables.put(keyed.join(shared, "key"))                  # buckets of several nodes only
    some = tables.put(in_buckets.select("id").distinct())
    weight = in_buckets.join(in_buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "key").groupBy("id").agg(F.sum("size").alias("weight"))
    places = tables.put(in_buckets.join(nodes.select("id", *_PLACES).join(weight, "id"), "id"))
    repeats = bool(real.groupBy("id").count().where("count > 1").limit(1).count())
    node_texts = where_marked(texts, F.col("id"), some).join(some, "id", "left_semi")
    node_texts = tables.put(node_texts.dropDuplicates() if repeats else node_texts)
    near = F.expr(_near(percent, sketch_bound(percent)))
    # The first star finds differences from the centre also where a link is out of question: the rest needs them.
    around = F.expr(_near(percent, FIRST_DIFFERENCES))

    checked = edges = comps = None

    def labelled() -> DataFrame:
        if comps is None:
            return places.withColumn("comp", F.col("id"))
        return places.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))

    for turn in range(STAR_ROUNDS + 1):
        at = labelled()
        first = F.struct((F.lit(0) if turn else -F.col("weight")).alias("w"), F.xxhash64(F.lit(turn), "id").alias("h"),
                         *[F.col(c) for c in ("id", "comp", *_PLACES)])
        open_keys = at.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(first).alias("p")).where("lo <> hi")
        if turn < STAR_ROUNDS:
            pivots = open_keys.select("key", "p.*").drop("w", "h")
            if not turn:
                pivots = centres = tables.put(pivots)
            pairs = at.alias("b").join(pivots.alias("a"), "key").where("a.comp <> b.comp").where(near if turn else around)
        else:
            known = overlaps.select(F.col("a").alias("pivot"), F.col("b").alias("id"), "linked", "pivot_n", "differ")
            rest = at.join(open_keys.select("key"), "key").join(centres.select("key", F.col("id").alias("pivot")), "key").where("id <> pivot")
            rest = tables.put(rest.join(known, ["pivot", "id"], "left"))
            met = _share_differences(rest.where("linked IS NOT NULL"), percent, near)
            # Nodes that the sketch puts so far from the pivot that nothing was counted: pairs of the bucket.
            far = rest.where("linked IS NULL").alias("a").join(rest.drop("differ").alias("b"), F.expr("a.key = b.key AND a.comp <> b.comp") & near)
            pairs = met.unionByName(far.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"))).distinct()
            pairs = pairs.select(F.struct(F.col("a").alias("id")).alias("a"), F.struct(F.col("b").alias("id")).alias("b"))
        pairs = pairs.select("a.id", "b.id").toDF("a", "b").distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti").join(checked.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        pairs = tables.put(pairs)
        found = tables.put(confirm_pairs(pairs, node_texts, shingle, percent))
        if not turn:
            overlaps = found
        linked = found.where("linked").select("a", "b")
        checked = pairs if checked is None else checked.union(pairs)
        edges = linked if edges is None else edges.union(linked)
        comps = components(tables, edges)

    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    # From sets to documents; repeated ids with different texts join their components once more.
    labels = nodes.select("set1", "set2", "n", "id").join(comps, "id", "left").join(links, "id", "left") \
        .select("set1", "set2", "n", F.coalesce("comp", "id").alias("comp"), F.coalesce("links", F.lit(0)).alias("links"))
    out = signed.join(labels, ["set1", "set2", "n"], "left")
    if repeats:
        spread = real.join(labels, ["set1", "set2", "n"]).select(F.col("comp").alias("a"), F.col("id").alias("b"))
        joined = components(tables, spread).select(F.col("id").alias("comp"), F.col("comp").alias("top"))
        out = out.join(joined, "comp", "left").withColumn("comp", F.coalesce("top", "comp")).drop("top")
    return out.select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("comp", "id")).alias("comp"),
                      F.coalesce("links", F.lit(0)).alias("links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The documents whose id is the smallest of their group (null ids stay), with all their columns."""
    groups = near_groups(docs, id_col, text_col, **params)
    gone = groups.where("id <> comp").select(F.col("id").alias("__gone")).distinct()
    kept = docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
    twice = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__twice")).count().where("count > 1").select("__twice")
    if not twice.limit(1).count():
        return kept
    first = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_last(), F.xxhash64(*docs.columns))
    again = kept.join(twice, kept[id_col] == twice["__twice"], "left_semi").withColumn("__nth", F.row_number().over(first))
    return kept.join(twice, kept[id_col] == twice["__twice"], "left_anti").unionByName(again.where("__nth = 1").drop("__nth"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, 85 of 100."""
    g = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, percent=85)
    return g.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"),
                    F.coalesce(F.col("id") == F.col("comp"), F.lit(True)).alias("kept"))
