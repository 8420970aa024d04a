"""Alternating least squares over chunked ratings.

Both copies of the ratings, sorted by user and by item, are cut into chunks of at most
``CHUNK`` ratings, each stored as one row under the checkpoint folder.  Consecutive chunks
form blocks of equally many ratings.  A half step

* sends every block the factors of the other side's ids that its chunks name, once per block
  and id (one equi-join with the stored list of an id's blocks), and its chunks, packed;
* forms, chunk by chunk, the Gram matrix and right side of every id's normal equations;
* solves at once what is complete.  Ratings are sorted, so only a chunk's first and last id
  can go on in a neighbour; their partial sums, two rows a chunk at most, are added up by a
  pre-aggregated sum per matrix cell and solved then.

What is sent grows with the number of blocks, so there are few: ``BLOCKS``, or as many as
hold ``BLOCK_RATINGS`` ratings each.  A task holds the factors that its block names, at most
one per rating, and its packed chunks.  A user or item that holds a third of all ratings is
a third of the chunks and blocks, and adds one partial row per chunk.  Nothing passes through
the driver.  A model scores pairs in the same way: sorted, cut and packed, and met by both sides'
factors in few blocks, so no pair is shuffled with a factor; its training pairs are scored in the
chunks that the fit stored.  The loss is the sum of squared errors with regularisation weighted by an id's number
of ratings (ALS-WR, as Spark's own ALS for explicit ratings); every iteration solves the
items, then the users.

The start is a function of id, dimension and seed, so a fit is reproducible whatever the
partitioning.  Ids may be any integers.  Rows with a null id or rating are not trained on;
repeated rows count each.  An empty table gives empty factor tables.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StructField, StructType

from tessera.operators.recommend import recommend_for_all
from tessera.operators.split import HASH_SPACE, text_hash
from tessera.session import scratch_path

CHUNK = 8192
BLOCKS = 6                     # fewest blocks of a half step
BLOCK_RATINGS = 1 << 25        # most ratings of a block, which bound what its task holds
RESIDUAL_RATINGS = 1 << 23     # most ratings of a block when residuals are formed: once, with the factors of both sides
BLOCK_BYTES = 1 << 28          # most bytes of its packed chunks, as pairs to score may have wide columns
FACTORS = "id bigint, features array<double>"
_CHUNKS = "chunk bigint, ids array<bigint>, others array<bigint>, packed binary"
_COLUMNS = ("ids", "others", "ratings")
_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_EXACT = (*_INTEGERS[:3], "float", "double")                     # what comes back from the doubles of a chunk as it was


def _packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> tuple[np.ndarray, ...]:
    """(ids, others, ratings) of a chunk."""
    rows = pa.ipc.open_stream(packed).read_next_batch()
    return tuple(rows.column(i).to_numpy() for i in range(len(_COLUMNS)))


def _cut(batches):
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cuts = np.linspace(0, n, math.ceil(n / CHUNK) + 1).astype(np.int32)      # of equal size
        rows = pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(_COLUMNS))], names=_COLUMNS)
        yield pa.record_batch({
            "chunk": pa.array((part << 33) + number + np.arange(len(cuts) - 1)),
            **{name: pa.ListArray.from_arrays(pa.array(cuts), batch.column(i)) for i, name in enumerate(_COLUMNS[:2])},
            "packed": pa.array([_packed(rows.slice(lo, hi - lo)) for lo, hi in zip(cuts.tolist(), cuts[1:].tolist())], pa.binary())})
        number += len(cuts) - 1


def rating_chunks(ratings: DataFrame, solve: str, other: str, rating: str, path: str) -> DataFrame:
    """(chunk, ids, others, packed): the ratings in order of (solve, other), cut into chunks and stored; packed: all three columns."""
    view = ratings.selectExpr(f"CAST(`{solve}` AS BIGINT) AS ids", f"CAST(`{other}` AS BIGINT) AS others", f"CAST(`{rating}` AS DOUBLE) AS ratings") \
        .where("ids IS NOT NULL AND others IS NOT NULL AND ratings IS NOT NULL")
    spread = view.withColumn("spread", F.spark_partition_id())                   # a pair rated very often is dealt out
    ordered = spread.repartitionByRange("ids", "others", "spread").sortWithinPartitions("ids", "others").drop("spread")
    ordered.mapInArrow(_cut, _CHUNKS).write.parquet(path)
    return ratings.sparkSession.read.parquet(path)


def pair_chunks(pairs: DataFrame, user: str, item: str, path: str) -> DataFrame:
    """As ``rating_chunks`` by user, with all rows; packed: user and item id (null if it is no integer), and the whole row."""
    whole = lambda c: F.expr(f"CASE WHEN try_cast(`{c}` AS BIGINT) = `{c}` THEN try_cast(`{c}` AS BIGINT) END")
    spread = pairs.withColumn("__spread", F.spark_partition_id())
    ordered = spread.repartitionByRange(F.col(f"`{user}`"), F.col(f"`{item}`"), "__spread").sortWithinPartitions(F.col(f"`{user}`"), F.col(f"`{item}`"))
    rows = ordered.select(whole(user).alias("ids"), whole(item).alias("others"), F.struct(*[F.col(f"`{c}`") for c in pairs.columns]).alias("row"))
    rows.mapInArrow(_cut, _CHUNKS).write.parquet(path)
    return pairs.sparkSession.read.parquet(path)


class Blocks(NamedTuple):
    """Chunks with their `block`, the number of blocks, and where the chunks are stored."""
    chunks: DataFrame
    count: int
    path: str


def in_blocks(chunks: DataFrame, path: str, most: int = BLOCK_RATINGS) -> Blocks:
    """Consecutive chunks in blocks of equally many chunks, about ``most`` ratings at most."""
    part = F.shiftright("chunk", 33)
    sizes = F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ratings"), F.sum(F.length("packed")).alias("bytes")
    per = {r.part: r for r in chunks.groupBy(part.alias("part")).agg(*sizes).collect()}                                                 # a row per task
    if not per:
        return Blocks(chunks.withColumn("block", F.lit(0)), 1, path)
    total = sum(r.n for r in per.values())
    count = min(total, max(BLOCKS, math.ceil(sum(r.ratings for r in per.values()) / most), math.ceil(sum(r.bytes for r in per.values()) / BLOCK_BYTES)))
    before = np.cumsum([0] + [per[p].n if p in per else 0 for p in range(max(per))]).tolist()
    place = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in before]), (part + 1).cast("int")) + F.col("chunk") - F.shiftleft(part, 33)
    return Blocks(chunks.withColumn("block", F.floor(place * count / total).cast("int")), count, path)


def block_needs(blocks: Blocks, column: str) -> DataFrame:
    """(id, blocks): the blocks in whose chunks an id of the column stands, stored."""
    path = f"{blocks.path}-{column}"
    (blocks.chunks.select("block", F.explode(F.array_distinct(column)).alias("id")).distinct()
     .groupBy("id").agg(F.collect_list("block").alias("blocks")).write.parquet(path))
    return blocks.chunks.sparkSession.read.parquet(path)


def _met(blocks: Blocks, *fed: tuple[DataFrame, DataFrame]) -> DataFrame:
    """The chunks of a block in one task with the factors of the ids it needs; `side` is the place of (needs, factors) in ``fed``."""
    single = all(isinstance(factors.schema["features"].dataType.elementType, FloatType) for _, factors in fed)
    kind = f"array<{'float' if single else 'double'}>"                            # single precision stays as it is
    rows = blocks.chunks.selectExpr("block", "packed", "CAST(NULL AS TINYINT) AS side", "CAST(NULL AS BIGINT) AS id", f"CAST(NULL AS {kind}) AS features")
    for side, (needs, factors) in enumerate(fed):
        sent = needs.join(factors, "id").select(
            F.explode("blocks").alias("block"), F.lit(None).cast("binary").alias("packed"), F.lit(side).cast("tinyint").alias("side"),
            "id", F.col("features").cast(kind).alias("features"))
        rows = rows.unionByName(sent)
    return rows.repartitionById(blocks.count, F.col("block")).drop("block")


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, offsets) of a list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = col.offsets.to_numpy()
    return col.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]] if len(col) else np.empty(0), off - off[0]


def _equations(ids: np.ndarray, X: np.ndarray, r: np.ndarray):
    """Per distinct id (ascending): its number of ratings, Gram matrix and right side."""
    starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    k = X.shape[1]
    gram = np.empty((len(starts), k, k))
    for a in range(k):
        gram[:, a, a:] = np.add.reduceat(X[:, a:a + 1] * X[:, a:], starts, axis=0)
        gram[:, a:, a] = gram[:, a, a:]
    return ids[starts], np.diff(np.append(starts, len(ids))), gram, np.add.reduceat(X * r[:, None], starts, axis=0)


def _solved(n: np.ndarray, gram: np.ndarray, right: np.ndarray, reg: float) -> np.ndarray:
    k = gram.shape[1]
    return np.linalg.solve(gram + (reg * n)[:, None, None] * np.eye(k), right[:, :, None])[:, :, 0]


def _array(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


class _Factors:
    """The factors of one side that were sent to a task."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], rank: int):
        """Empties ``parts``, so that they are not held twice."""
        n = sum(len(i) for i, _ in parts)
        ids, self.rows = np.empty(n, np.int64), np.empty((n, rank), parts[0][1].dtype if parts else float)
        while parts:
            i, x = parts.pop()
            ids[n - len(i):n], self.rows[n - len(i):n] = i, x
            n -= len(i)
        self.order = np.argsort(ids).astype(np.int32 if len(ids) < 1 << 31 else np.int64)
        self.sorted = ids[self.order]

    def at(self, places: np.ndarray) -> np.ndarray:
        return self.rows[places].astype(np.float64, copy=False)

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the ids' rows, whether they have one)."""
        if not len(self.sorted):
            return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(self.sorted, ids), len(self.sorted) - 1)
        return self.order[at], self.sorted[at] == ids


def _gathered(batches, rank: int, sides: int) -> tuple[list[bytes], list[_Factors]]:
    """The packed chunks and the factors, side by side, that a task was sent."""
    chunks, parts = [], [[] for _ in range(sides)]
    for batch in batches:
        packed, side, ids, features = batch.columns
        chunks += packed.drop_null().to_pylist()
        for k in range(sides):
            mine = pa.compute.fill_null(pa.compute.equal(side, k), False)
            if mine.true_count:
                parts[k].append((ids.filter(mine).to_numpy(), _lists(features.filter(mine))[0].reshape(-1, rank)))
    return chunks, [_Factors(parts.pop(0), rank) for _ in range(sides)]


def _half(rank: int, reg: float):
    """Chunks with their factors -> solved ids (features) and partial sums (Gram matrix, right side and count in one array)."""
    def run(batches):
        chunks, (other,) = _gathered(batches, rank, 1)
        for packed in chunks:
            ids, others, ratings = _unpacked(packed)
            place, known = other.of(others)
            if not known.any():
                continue
            u, n, gram, right = _equations(ids[known], other.at(place[known]), ratings[known])
            whole = (u != ids[0]) & (u != ids[-1])
            if whole.any():
                got = _solved(n[whole], gram[whole], right[whole], reg)
                yield pa.record_batch({"id": pa.array(u[whole]), "features": _array(got), "sums": pa.nulls(len(got), pa.list_(pa.float64()))})
            open_ = ~whole
            if open_.any():
                sums = np.hstack((gram[open_].reshape(-1, rank * rank), right[open_], n[open_, None].astype(float)))
                yield pa.record_batch({"id": pa.array(u[open_]), "features": pa.nulls(len(sums), pa.list_(pa.float64())), "sums": _array(sums)})
    return run


def _finish(rank: int, reg: float):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sums = _lists(batch.column(1))[0].reshape(batch.num_rows, -1)
                cells = rank * rank
                got = _solved(sums[:, -1], sums[:, :cells].reshape(-1, rank, rank), sums[:, cells:-1], reg)
                yield pa.record_batch({"id": batch.column(0), "features": _array(got)})
    return run


def half_step(blocks: Blocks, needs: DataFrame, factors: DataFrame, rank: int, reg: float, path: str) -> DataFrame:
    """Factors (id, features) of the chunks' ids, the other side's being fixed.

    ``needs`` is (id, blocks): the blocks that name the other side's ids.  A rating whose other id
    has no factors is left out.
    """
    _met(blocks, (needs, factors)).mapInArrow(_half(rank, reg), f"{FACTORS}, sums array<double>").write.parquet(path)
    half = factors.sparkSession.read.parquet(path)
    cells = half.where("sums IS NOT NULL").select("id", F.posexplode("sums").alias("at", "v")).groupBy("id", "at").agg(F.sum("v").alias("v"))
    sums = cells.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("s")).select("id", F.col("s.v").alias("sums"))
    return half.where("features IS NOT NULL").select("id", "features").unionByName(sums.mapInArrow(_finish(rank, reg), FACTORS))


def _residuals(rank: int, reg: float):
    """Chunks with both sides' factors -> (id, sums): sum v (v.u - r) + reg n u in `rank` places and sum |r|, per chunk and id."""
    def run(batches):
        chunks, (other, own) = _gathered(batches, rank, 2)
        for packed in chunks:
            ids, others, ratings = _unpacked(packed)
            (v, met), (u, fitted) = other.of(others), own.of(ids)
            known = met & fitted
            if not known.any():
                continue
            V, U, ratings = other.at(v[known]), own.at(u[known]), ratings[known]
            given = ~np.isnan(ratings)
            error = np.where(given, (U * V).sum(axis=1) - ratings, 0.0)
            rows = np.hstack((error[:, None] * V + reg * U, np.where(given, np.abs(ratings), 0.0)[:, None]))
            starts = np.flatnonzero(np.concatenate(([True], ids[known][1:] != ids[known][:-1])))
            yield pa.record_batch({"id": pa.array(ids[known][starts]), "sums": _array(np.add.reduceat(rows, starts, axis=0))})
    return run


def equation_residuals(train: DataFrame, userFactors: DataFrame, itemFactors: DataFrame, rank: int, reg: float, user: str, item: str, rating: str) -> DataFrame:
    """(id, g, scale): per user sum v (v.u - r) + reg n u over the pairs of known ids, and sum |r|; a null rating only counts in n."""
    base = scratch_path(train.sparkSession, "residuals")
    rated = train.select(user, item, F.coalesce(F.col(rating).cast("double"), F.lit(float("nan"))).alias(rating))
    blocks = in_blocks(rating_chunks(rated, user, item, rating, f"{base}/users"), f"{base}/users", RESIDUAL_RATINGS)
    met = _met(blocks, (block_needs(blocks, "others"), itemFactors), (block_needs(blocks, "ids"), userFactors))
    sums = met.mapInArrow(_residuals(rank, reg), "id bigint, sums array<double>").groupBy("id").agg(*[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(rank + 1)])
    return sums.select("id", F.array(*[f"s{k}" for k in range(rank)]).alias("g"), F.col(f"s{rank}").alias("scale"))


def _scored(rank: int, drop_cold: bool, names: list[str], prediction: str):
    """Chunks of pairs or ratings with both sides' factors -> the pairs' rows and their score, null if an id has no factors (dropped if ``drop_cold``)."""
    def run(batches):
        chunks, (other, own) = _gathered(batches, rank, 2)
        for packed in chunks:
            ids, others, row = pa.ipc.open_stream(packed).read_next_batch().columns
            known = ids.is_valid().to_numpy(zero_copy_only=False) & others.is_valid().to_numpy(zero_copy_only=False)
            (v, met), (u, fitted) = other.of(others.fill_null(0).to_numpy()), own.of(ids.fill_null(0).to_numpy())
            known &= met & fitted
            score = np.zeros(len(known))
            score[known] = (own.at(u[known]) * other.at(v[known])).sum(axis=1)
            columns = row.flatten() if pa.types.is_struct(row.type) else [ids, others, row]
            rows = pa.RecordBatch.from_arrays([*columns, pa.array(score, mask=~known)], names=[*names, prediction])
            yield rows.filter(pa.array(known)) if drop_cold else rows
    return run


def score_blocks(blocks: Blocks, itemNeeds: DataFrame, userFactors: DataFrame, itemFactors: DataFrame, rank: int,
                 schema: StructType, drop_cold: bool, prediction: str) -> DataFrame:
    """The rows of stored chunks, by ``schema``, with their score."""
    met = _met(blocks, (itemNeeds, itemFactors), (block_needs(blocks, "ids"), userFactors))
    return met.mapInArrow(_scored(rank, drop_cold, schema.names, prediction), StructType([*schema.fields, StructField(prediction, DoubleType())]))


def score_pairs(pairs: DataFrame, userFactors: DataFrame, itemFactors: DataFrame, rank: int, user: str, item: str,
                drop_cold: bool = True, prediction: str = "prediction") -> DataFrame:
    """J1/J2 as ``predict_pairs``, in blocks of packed pairs; factor ids are unique.  Cold-start pairs are dropped or get null."""
    path = f"{scratch_path(pairs.sparkSession, 'pairs')}/users"
    pairs = pairs.drop(prediction)
    blocks = in_blocks(pair_chunks(pairs, user, item, path), path)
    scored = score_blocks(blocks, block_needs(blocks, "others"), userFactors, itemFactors, rank, pairs.schema, drop_cold, prediction)
    return scored.select(*[F.col(f"`{c}`") for c in dict.fromkeys((item, user, *scored.columns))])               # in the order of two joins


def start_factors(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """(id, features) in (0, 1): the hash of seed, id and dimension."""
    one = lambda d: text_hash(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"), F.lit(str(d)))) / F.lit(float(HASH_SPACE))
    return ids.select("id", F.array(*[one(d) for d in range(rank)]).alias("features"))


class Trained(NamedTuple):
    """What a fit stored of its training pairs: their blocks by user, and which of these name an item."""
    pairs: DataFrame
    rating: str
    blocks: Blocks
    itemNeeds: DataFrame


class ChunkedALSModel:
    """Factor tables (id, features) with the scoring surface of a fitted ALS model."""

    def __init__(self, userFactors: DataFrame, itemFactors: DataFrame, rank: int, user: str, item: str, cold_start: str, prediction: str = "prediction",
                 trained: Trained | None = None):
        self._trained = trained
        self.userFactors, self.itemFactors, self.rank = userFactors, itemFactors, rank
        self._user, self._item, self._cold, self._prediction = user, item, cold_start, prediction

    def getUserCol(self) -> str:
        return self._user

    def getItemCol(self) -> str:
        return self._item

    def getPredictionCol(self) -> str:
        return self._prediction

    def _stored(self, pairs: DataFrame) -> bool:
        """Whether the chunks of the fit hold these pairs: the same table, of these columns only, and no row was left out for a null."""
        if self._trained is None or pairs.columns != self._trained.pairs.columns or not pairs.sameSemantics(self._trained.pairs):
            return False                                                         # the same plan may have other column names
        ids, rating = (self._user, self._item), self._trained.rating
        types = dict(pairs.dtypes)
        if len(pairs.columns) != 3 or set(types) != {*ids, rating} or types[rating] not in _EXACT or any(types[c] not in _INTEGERS for c in ids):
            return False
        return pairs.where(" OR ".join(f"`{c}` IS NULL" for c in pairs.columns)).isEmpty()

    def transform(self, pairs: DataFrame) -> DataFrame:
        """Scored pairs; those of unseen ids are dropped, or get null if ``cold_start`` is "nan"."""
        drop = self._cold == "drop"
        if not self._stored(pairs):
            return score_pairs(pairs, self.userFactors, self.itemFactors, self.rank, self._user, self._item, drop_cold=drop, prediction=self._prediction)
        _, rating, blocks, needs = self._trained
        names = (self._item, self._user, rating)
        schema = StructType([StructField(c, t) for c, t in ((self._user, LongType()), (self._item, LongType()), (rating, DoubleType()))])
        scored = score_blocks(blocks, needs, self.userFactors, self.itemFactors, self.rank, schema, drop, self._prediction)
        return scored.select(*[F.col(f"`{c}`").cast(pairs.schema[c].dataType).alias(c) for c in names], F.col(f"`{self._prediction}`"))

    def recommendForAllUsers(self, k: int) -> DataFrame:
        return recommend_for_all(self, k, users=True)

    def recommendForAllItems(self, k: int) -> DataFrame:
        return recommend_for_all(self, k, users=False)


def fit_chunked_als(train: DataFrame, user: str = "user", item: str = "item", rating: str = "rating", rank: int = 10,
                    maxIter: int = 10, regParam: float = 0.1, seed: int = 42, cold_start: str = "drop",
                    start: DataFrame | None = None) -> ChunkedALSModel:
    """Alternating least squares; ``start`` (id, features) replaces the hashed start of the users."""
    if rank < 1 or maxIter < 1 or regParam <= 0:
        raise ValueError("rank and maxIter must be at least 1, regParam above 0")
    if cold_start not in ("drop", "nan"):
        raise ValueError(f"cold_start must be 'drop' or 'nan', got {cold_start!r}")
    base = scratch_path(train.sparkSession, "als")
    sides, needs = {}, {}
    for name, solve, other in (("user", user, item), ("item", item, user)):
        path = f"{base}/{name}s"
        sides[name] = in_blocks(rating_chunks(train, solve, other, rating, path), path)
        needs[name] = block_needs(sides[name], "others")
    if start is None:
        start = start_factors(sides["user"].chunks.select(F.explode(F.array_distinct("ids")).alias("id")).distinct(), rank, seed)
    users = start
    for step in range(maxIter):
        items = half_step(sides["item"], needs["item"], users, rank, regParam, f"{base}/items-{step}")
        users = half_step(sides["user"], needs["user"], items, rank, regParam, f"{base}/users-{step}")
    return ChunkedALSModel(users, items, rank, user, item, cold_start, trained=Trained(train, rating, sides["user"], needs["user"]))
