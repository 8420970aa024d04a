"""Mixing sources to target weights in fixed-length token blocks.

Per source, the documents (in hash order) form one stream of tokens, cut into blocks of
BLOCK tokens; the last one may be shorter.  A source's target is reached by slots:
`target // size` whole passes over its blocks, then as many blocks in permuted order as the
rest needs, the last cut to length.  So the words taken are the target rounded down, and no
block is used more than `CAP` times.

Which slots go to which output shard is drawn: the counts of a source's slots over the
shards are multinomial (given the source's total), from a seed and the source's name.  Slot
j of a pass is block pi(j), pi being the source's pseudorandom permutation: a keyed Feistel
network, walked until it falls into the range, so that no permutation is stored.  Slots join
the blocks by (source, block).

Weights repeat along the sources in code-point order, null last.  Targets share
SHARE * (all sizes) by weight; one that exceeds CAP times its source's size is set to that,
and the excess is shared again by weight among the others until none is above.

Stream positions need no task per source: a source's rows are dealt over BUCKETS hash
buckets, summed per bucket, and a row's position is its bucket's offset plus the sum inside
the bucket.  A source holding a third of the rows is many buckets.

Defined cases.  Null and blank texts have size 0 and nothing is taken of them; a source of
such texts has target 0.  A null source is a source, the last one.  Repeated rows are taken
each by itself.  Empty tables give empty results.  Columns other than id, text and source
are carried along by `mix`, and not read by the query.  `mix` tells rows with equal id, text
and source apart by a hash of their other columns, so each keeps its own; only rows that are
equal in everything are interchangeable.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from tessera.llm import tokens as T
from tessera.llm.sharding import ranked
from tessera.session import scratch_path

BLOCK = 512
BUCKETS = 1024
SHARDS = 16
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = 20240229
_ROUNDS = 6
_RUN = 4096


def _feistel(x: np.ndarray, half: np.ndarray, key: np.ndarray, back: bool) -> np.ndarray:
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    for r in (range(_ROUNDS - 1, -1, -1) if back else range(_ROUNDS)):
        if back:
            left, right = right ^ (T.mix64(left + key * np.uint64(2 * r + 1)) & mask), left
        else:
            left, right = right, left ^ (T.mix64(right + key * np.uint64(2 * r + 1)) & mask)
    return left << half | right


def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """Place of x among 0 .. n - 1 under the permutation of that key (or the place it comes from)."""
    x, n, key = (np.asarray(v).astype(np.uint64) for v in (x, n, key))
    half = np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2).astype(np.uint64)
    half += ((np.uint64(1) << (half + half)) < n).astype(np.uint64)
    out = _feistel(x, half, key, back)
    while len(walk := np.flatnonzero(out >= n)):
        out[walk] = _feistel(out[walk], half[walk], key[walk], back)
    return out.astype(np.int64)


def count_words(col: pa.Array) -> np.ndarray:
    """Words of `[^\\x20\\x09-\\x0D]+` per row."""
    raw, off = T.column_bytes(col)
    inside = T.word_table(T.SPACE_SEPARATORS)[raw]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    at = off[:-1][off[:-1] < len(raw)]
    start[at] = inside[at]
    return np.diff(np.searchsorted(np.flatnonzero(start), off))


def _sizes(batches):
    for part in T.chunks(batches):
        yield pa.record_batch({"id": part.column(0), "source": part.column(2), "copy": part.column(3), "twin": part.column(4), "size": pa.array(count_words(part.column(1)))})


def _twin(docs: DataFrame, columns: list[str]) -> Column:
    """A hash of the columns; nulls count with their place, which xxhash64 alone skips."""
    parts = []
    for c in columns:
        kind, col = docs.schema[c].dataType, F.col(f"`{c}`")
        nested = isinstance(kind, (ST.ArrayType, ST.MapType, ST.StructType))
        parts += [col.isNull(), F.to_json(F.struct(col), {"ignoreNullFields": "false"}) if nested else col]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Per source: source, source_size, weight, target."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("last", F.col("source").isNull())
    rows, _ = ranked(per, ["last", "source"])
    rows = rows.select("source", "source_size", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1).alias("weight"))
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    # Rounds of sharing again: at most one per source, in practice few; each is one aggregate over the sources.
    left, over, capped = share * total, sum(weights), -1
    left_col = F.lit(0.0)
    while True:
        above = F.col("weight") * F.lit(float(left)) / F.lit(float(over)) > cap * F.col("source_size") if capped >= 0 else F.lit(False)
        r = rows.agg(F.count(F.when(above, 1)).alias("n"), F.sum(F.when(above, cap * F.col("source_size")).otherwise(0)).alias("kept"),
                     F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("w")).first()
        new_left, new_over = share * total - (r["kept"] or 0), r["w"] or 0
        if r["n"] == capped or not new_over:
            break
        left, over, capped = new_left, new_over, r["n"]
    value = F.col("weight") * F.lit(float(left)) / F.lit(float(over))
    return rows.withColumn("target", F.least(value, (cap * F.col("source_size")).cast("double")))


def _draw(shards: int, block: int, seed: int):
    """Runs of slots per source and output shard."""
    def run(frames):
        for f in frames:
            out = []
            for source, size, target in zip(f["source"], f["source_size"].astype("int64"), f["target"]):
                if size <= 0:
                    continue
                blocks = -(-size // block)
                words = int(target)
                passes, rest = divmod(words, size)
                slots = passes * blocks + (min(blocks, -(-rest // block) + 1) if rest else 0)
                name = b"" if source is None else b"s" + source.encode()
                key = int(T.Words(pa.array([name.hex()]), np.ones(256, bool)).hash[0]) if name else 0
                key = (key ^ seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
                counts = np.random.default_rng([seed, key]).multinomial(slots, np.full(shards, 1 / shards))
                ends = np.cumsum(counts)
                for shard in range(shards):
                    for lo in range(int(ends[shard] - counts[shard]), int(ends[shard]), _RUN * 256):
                        out.append((source, size, passes, rest, blocks, key - (1 << 64) if key >> 63 else key, shard, lo, min(int(ends[shard]), lo + _RUN * 256)))
            yield pd.DataFrame(out, columns=["source", "size", "passes", "rest", "blocks", "key", "shard", "lo", "hi"])
    return run


def _slots(block: int):
    """Every slot of the runs: which block it takes, and how many of its words."""
    def run(frames):
        for f in frames:
            if not len(f):
                continue
            n = (f["hi"] - f["lo"]).to_numpy()
            row = np.repeat(np.arange(len(f)), n)
            slot = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(f["lo"].to_numpy(), n)
            size, passes, rest, blocks, key = (f[c].to_numpy()[row] for c in ("size", "passes", "rest", "blocks", "key"))
            key = key.view(np.uint64)
            turn, j = slot // blocks, slot % blocks
            at = permuted(j, blocks, key)
            last = size - (blocks - 1) * block
            length = np.where(at == blocks - 1, last, block)
            short = permuted(blocks - 1, blocks, key, back=True)           # where the shorter block stands in the pass
            before = j * block - np.where(j > short, block - last, 0)
            take = np.where(turn < passes, length, np.clip(rest - before, 0, length))
            keep = take > 0
            yield pd.DataFrame({"source": f["source"].to_numpy(object)[row][keep], "shard": f["shard"].to_numpy()[row][keep].astype("int32"),
                                "slot": slot[keep], "pass": turn[keep].astype("int32"), "block": at[keep], "take": take[keep]})
    return run


def draw_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK,
             shards: int = SHARDS, seed: int = SEED, weights=WEIGHTS, share: float = SHARE, cap: int = CAP,
             twin: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(a row per document row: id, copy, twin, source, size, source_size, target, start;
    a row per piece taken: source, start, id, copy, twin, shard, slot, pass, lo, hi in words of the document).
    `twin` tells rows with equal id, text and source apart."""
    spark = docs.sparkSession
    base = scratch_path(spark, "mixing")
    id_kind, source_kind = (docs.schema[c].dataType.simpleString() for c in (id_col, source_col))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"), F.xxhash64(F.col(text_col)).alias("copy"),
                        (F.lit(0).cast("long") if twin is None else twin).alias("twin"))
    sized = texts.mapInArrow(_sizes, f"id {id_kind}, source {source_kind}, copy long, twin long, size long")
    sized = sized.withColumn("place", F.xxhash64(F.lit(seed), "id", "copy"))
    sized.withColumn("bucket", F.pmod("place", F.lit(BUCKETS))).write.parquet(f"{base}/sized")
    sized = spark.read.parquet(f"{base}/sized")
    source_targets(sized, weights, share, cap).write.parquet(f"{base}/targets")
    targets = spark.read.parquet(f"{base}/targets")

    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("s"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "bucket", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("place", "id", "copy", "size", "twin").rowsBetween(Window.unboundedPreceding, -1)
    placed = _same(sized.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))), offsets, ["source", "bucket"])
    placed = _same(placed, targets.drop("weight"), ["source"]).select(
        "id", "copy", "twin", "source", "size", "source_size", "target", F.expr("offset + inner").alias("start"))
    placed.write.parquet(f"{base}/placed")
    placed = spark.read.parquet(f"{base}/placed")

    segments = placed.where("size > 0").select(
        "id", "copy", "twin", "source", "start", "size",
        F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block"))
    runs = targets.select("source", "source_size", "target").mapInPandas(
        _draw(shards, block, seed), f"source {source_kind}, size long, passes long, rest long, blocks long, key long, shard int, lo long, hi long")
    runs = runs.withColumn("part", F.explode(F.expr(f"sequence(lo, hi - 1, {_RUN}L)"))) \
        .withColumn("lo", F.col("part")).withColumn("hi", F.least("hi", F.expr(f"part + {_RUN}L"))).drop("part")
    slots = runs.repartition(F.xxhash64("source", "lo")).mapInPandas(
        _slots(block), f"source {source_kind}, shard int, slot long, pass int, block long, take long")
    pieces = _same(segments, slots, ["source", "block"]).select(
        "id", "copy", "twin", "source", "start", "shard", "slot", "pass",
        F.expr(f"greatest(block * {block} - start, 0L)").alias("lo"),
        F.expr(f"least(start + size, block * {block} + least({block}L, take)) - start").alias("hi")).where("hi > lo")
    return placed, pieces


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys are equal; the left side's keys stay."""
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"__{k}"]) for k in keys]
    for c in on[1:]:
        on[0] = on[0] & c
    return left.join(right, on[0], how).drop(*[f"__{k}" for k in keys])


def mix_report(docs: DataFrame, **params) -> DataFrame:
    """Per document row: id, size, source_size, target, taken (words, repeats counted)."""
    placed, pieces = draw_mix(docs, **params)
    taken = pieces.groupBy("source", "start").agg(F.sum(F.expr("hi - lo")).alias("words"))
    full = _same(placed.withColumn("at", F.when(F.col("size") > 0, F.col("start")).otherwise(-1)),
                 taken.withColumnRenamed("start", "at"), ["source", "at"], "left")
    return full.select("id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"))


def _cut_pieces(text: str, chars: str | None):
    def run(batches):
        for part in T.chunks(batches, text):
            names = part.schema.names
            col = part.column(names.index(text))
            w = T.Words(col, T.word_table(T.SPACE_SEPARATORS), lower=False)
            lo, hi = (part.column(names.index(c)).to_numpy() for c in ("__lo", "__hi"))
            whole = hi - lo == w.count
            a = np.where(whole, w.offsets[:-1], w.start[np.minimum(w.first + lo, len(w.start) - 1)])
            b = np.where(whole, w.offsets[1:], w.end[np.minimum(w.first + hi, len(w.end)) - 1])
            pieces = [w.data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(a, b)]
            cols = dict(zip(names, part.columns))
            cols[text] = pa.array(pieces, pa.string())
            if chars:
                cols[chars] = pa.array([len(p) for p in pieces]).cast(cols[chars].type)
            yield pa.record_batch({k: v for k, v in cols.items() if k not in ("__lo", "__hi")})
    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", source_col: str = "source", **params) -> DataFrame:
    """The mixture as documents with the same columns: a row per document and whole pass, and per piece of the
    passes that take parts of it (text and its length are the piece's)."""
    twin = _twin(docs, [c for c in docs.columns if c not in (id_col, text_col, source_col)])
    placed, pieces = draw_mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, twin=twin, **params)
    row = ["id", "copy", "twin", "source"]
    sizes = placed.select("source", "start", "size").where("size > 0")
    # Pieces of one document and pass that together are all of it are one row.
    whole = _same(pieces.groupBy(*row, "start", "pass").agg(F.sum(F.expr("hi - lo")).alias("words")), sizes, ["source", "start"])
    full = whole.where("words = size").select("source", "start", "pass")
    parts = _same(pieces, full, ["source", "start", "pass"], "left_anti").select(*row, "lo", "hi")
    taken = whole.where("words = size").select(*row, F.lit(0).cast("long").alias("lo"), F.col("size").alias("hi")).union(parts)
    taken = taken.select(*[F.col(c).alias(f"__{c}") for c in (*row, "lo", "hi")])
    one = docs.withColumn("__text_hash", F.xxhash64(F.col(text_col))).withColumn("__other_hash", twin)
    if placed.groupBy(*row).count().where("count > 1").limit(1).count():
        one = one.dropDuplicates([id_col, "__text_hash", "__other_hash", source_col])           # rows equal in everything: their pieces are listed together
    chosen = one.join(taken, one[id_col].eqNullSafe(taken["__id"]) & (one["__text_hash"] == taken["__copy"]) & (one["__other_hash"] == taken["__twin"])
                      & one[source_col].eqNullSafe(taken["__source"])).drop("__id", "__copy", "__twin", "__source", "__text_hash", "__other_hash")
    chars = chars_col if chars_col in docs.columns else None
    return chosen.mapInArrow(_cut_pieces(text_col, chars), chosen.drop("__lo", "__hi").schema)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share in the mixture."""
    m = mix_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return m.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
