"""Inputs for the driver queries, shaped from the test tables.

Each builder only reshapes whole test tables into the schema a workload
expects (ratings, labeled vectors, byte-valued matrices, factor tables).
None of them does any of the workload's own work; that lives in
``tessera.operators``.  The DuckDB text of every view is in
``tessera.plans.oracles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.split import hash_split
from tessera.session import scratch_path
from tessera.sources.tables import table

# Fixed view parameters (shared with the oracle SQL).
RATING_BIN = 12.5          # rating = 1 + floor(avg(quantity) / 12.5) -> 1..5
EMB_OFFSET, EMB_SCALE, EMB_LEVELS = 0.4, 10.0, 7   # byte bins 0..7
SPA_THRESHOLD = 0.1        # |e| below this is a zero in the sparse view
SVMLINE_SCALE = 1000.0
TRAIN_FRACTION = 0.8


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """RAT: (user int, item int, rating double 1..5, ts bigint), key (user, item).

    Two shuffles: the lineitem/orders equi-join on the order key, then the
    (customer, part) aggregate with map-side partial aggregation.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    g = (li.join(od, li.l_orderkey == od.o_orderkey)
         .groupBy("o_custkey", "l_partkey")
         .agg(F.avg("l_quantity").alias("q"), F.min("o_orderdate").alias("d")))
    return g.select(
        F.col("o_custkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("item"),
        (F.floor(F.col("q") / F.lit(RATING_BIN)) + 1).cast("double").alias("rating"),
        # Epoch seconds of a TIMESTAMP_NTZ without passing through the session zone.
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', d)").cast("bigint")
        .alias("ts"))


def rating_lines(spark: SparkSession, sf: str) -> DataFrame:
    """RATLINE: ``user::item::rating::ts`` text; lines whose md5 starts with '0'
    lose their last field (a malformed feed to exercise the bad-line path)."""
    r = ratings(spark, sf)
    full = F.concat_ws("::", *[F.col(c).cast("string") for c in ("user", "item", "rating", "ts")])
    short = F.concat_ws("::", *[F.col(c).cast("string") for c in ("user", "item", "rating")])
    return r.select(F.when(F.substring(F.md5(full), 1, 1) == "0", short)
                    .otherwise(full).alias("value"))


def rating_csv_lines(spark: SparkSession, sf: str) -> DataFrame:
    """RAT as comma-separated lines (the delimited-feed layout)."""
    r = ratings(spark, sf)
    return r.select(F.concat_ws(",", *[F.col(c).cast("string")
                                       for c in ("user", "item", "rating", "ts")]).alias("value"))


def rating_csv_feed(spark: SparkSession, sf: str) -> DataFrame:
    """RATCSV: the comma-separated lines, of which those whose md5 starts with '0' lose their last
    field and those with '1' have a rating that is no number."""
    r = ratings(spark, sf)
    text = [F.col(c).cast("string") for c in ("user", "item", "rating", "ts")]
    full = F.concat_ws(",", *text)
    first = F.substring(F.md5(full), 1, 1)
    return r.select(F.when(first == "0", F.concat_ws(",", *text[:3])).when(first == "1", F.concat_ws(",", *text[:2], F.lit("n/a"), text[3]))
                    .otherwise(full).alias("value"))


def clean_rating_lines(spark: SparkSession, sf: str) -> DataFrame:
    """RATLINE without bad lines."""
    return ratings(spark, sf).select(F.concat_ws("::", *[F.col(c).cast("string")
                                                       for c in ("user", "item", "rating", "ts")]).alias("value"))


def byte_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """EMB: (id bigint, y tinyint 0..2, x array<tinyint> of 64 bins 0..7)."""
    e = table(spark, sf, "embeddings")
    binned = F.transform("embedding", lambda v: F.floor(F.least(F.greatest(
        (v.cast("double") + F.lit(EMB_OFFSET)) * F.lit(EMB_SCALE), F.lit(0.0)),
        F.lit(float(EMB_LEVELS)))).cast("tinyint"))
    return e.select(F.col("vec_id").alias("id"), (F.col("label") % 3).cast("tinyint").alias("y"),
                    binned.alias("x"))


def sparse_sign_entries(spark: SparkSession, sf: str) -> DataFrame:
    """SPA long form: (id bigint, y tinyint, k int, v tinyint in {-1, 1}), non-zeros only."""
    e = table(spark, sf, "embeddings")
    signs = F.transform("embedding", lambda v: F.when(
        F.abs(v.cast("double")) < F.lit(SPA_THRESHOLD), F.lit(0)).otherwise(
        F.signum(v.cast("double"))).cast("tinyint"))
    ex = e.select(F.col("vec_id").alias("id"), (F.col("label") % 3).cast("tinyint").alias("y"),
                  F.posexplode(signs).alias("k", "v"))
    return ex.filter(F.col("v") != 0).select("id", "y", F.col("k").cast("int").alias("k"), "v")


def sparse_dimension(spark: SparkSession, sf: str) -> int:
    """Length of the SPA vectors (the embedding width)."""
    e = table(spark, sf, "embeddings")
    return int(e.agg(F.max(F.size("embedding"))).first()[0])


def lineitem_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """LIN: x = (quantity, 100*discount, 100*tax, linenumber) as bytes, y = return-flag code."""
    li = table(spark, sf, "lineitem")
    x = F.array(F.round("l_quantity").cast("tinyint"),
                F.round(F.col("l_discount") * 100).cast("tinyint"),
                F.round(F.col("l_tax") * 100).cast("tinyint"),
                F.col("l_linenumber").cast("tinyint"))
    y = (F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1)
         .otherwise(2).cast("tinyint"))
    return li.select(x.alias("x"), y.alias("y"))


def svm_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """SVMV: (id bigint, y double 0/1, wt double, features array<double>)."""
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    (F.col("label") < 5).cast("double").alias("y"),
                    (F.col("label") % 3 + 1).cast("double").alias("wt"),
                    F.transform("embedding", lambda v: v.cast("double")).alias("features"))


def svm_sparse_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """SVMS: (id, label, wt, features vector): SVMV with entries below SPA_THRESHOLD as zeros, mostly-zero rows stored sparse."""
    from pyspark.ml.feature import VectorAssembler
    v = svm_vectors(spark, sf)
    d = sparse_dimension(spark, sf)
    cut = v.select("id", F.col("y").alias("label"), "wt",
                   *[F.when(F.abs(F.col("features")[i]) < SPA_THRESHOLD, 0.0).otherwise(F.col("features")[i]).alias(f"e{i}") for i in range(d)])
    return VectorAssembler(inputCols=[f"e{i}" for i in range(d)], outputCol="features").transform(cut).select("id", "label", "wt", "features")


def svm_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """(label double 0/1, features array<double> of 5): the numeric columns of every lineitem row, returned or not."""
    li = table(spark, sf, "lineitem")
    x = F.array(F.col("l_quantity") / 50, F.col("l_extendedprice") / 100_000, F.col("l_discount") * 10,
                F.col("l_tax") * 10, F.col("l_linenumber") / 7.0)
    return li.select((F.col("l_returnflag") == "R").cast("double").alias("label"), x.alias("features"))


def svm_lines(spark: SparkSession, sf: str) -> DataFrame:
    """SVMLINE: ``label,id,v1 v2 ... v64`` with v = round(1000 * embedding)."""
    e = table(spark, sf, "embeddings")
    vals = F.array_join(F.transform("embedding", lambda v: F.round(
        v.cast("double") * F.lit(SVMLINE_SCALE)).cast("int").cast("string")), " ")
    return e.select(F.concat_ws(",", (F.col("label") < 5).cast("int").cast("string"),
                                F.col("vec_id").cast("string"), vals).alias("value"))


def rating_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) of RAT by the md5 key split, 80/20."""
    return hash_split(ratings(spark, sf), ["user", "item"], TRAIN_FRACTION)


def stored_ratings(spark: SparkSession, sf: str, columns: tuple[str, ...] = ("user", "item", "rating")) -> DataFrame:
    """Columns of RAT, joined and grouped once and written under the checkpoint folder, for
    queries that read the ratings several times."""
    path = scratch_path(spark, "ratings")
    ratings(spark, sf).select(*columns).write.parquet(path)
    return spark.read.parquet(path)


def stored_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) as ``rating_split`` without the time, from the stored ratings."""
    return hash_split(stored_ratings(spark, sf), ["user", "item"], TRAIN_FRACTION)


def factor_tables(spark: SparkSession, sf: str, train: DataFrame | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """FAC: (id int, features array<double>) for the users and for the items seen
    in the training split; the factor of id i is embedding row (i mod #rows).

    Users and items that occur only in the test split have no factors
    (the cold-start case).  ``train`` reuses an already built training split.  The distinct
    ids of both sides are stored, so reading a side again does not group the ratings again."""
    if train is None:
        train, _ = hash_split(stored_ratings(spark, sf, ("user", "item")), ["user", "item"], TRAIN_FRACTION)
    e = table(spark, sf, "embeddings")
    n_emb = e.count()
    vecs = e.select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("features"))

    def side(col: str) -> DataFrame:
        path = scratch_path(spark, f"{col}-ids")
        train.select(F.col(col).alias("id")).distinct().write.parquet(path)
        return (spark.read.parquet(path).join(vecs, F.pmod(F.col("id").cast("bigint"), F.lit(n_emb)) == F.col("vec_id"))
                .select("id", "features"))

    return side("user"), side("item")


def sparse_sign_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """SPA as an ml vector column: ``VectorAssembler`` stores mostly-zero rows sparse.

    (id bigint, label double, features vector)."""
    from pyspark.ml.feature import VectorAssembler
    e = table(spark, sf, "embeddings")
    d = sparse_dimension(spark, sf)
    signs = [f"CAST(CASE WHEN abs(CAST(embedding[{i}] AS DOUBLE)) < {SPA_THRESHOLD!r}D THEN 0 "
             f"ELSE signum(CAST(embedding[{i}] AS DOUBLE)) END AS DOUBLE) AS s{i}" for i in range(d)]
    wide = e.selectExpr("vec_id AS id", "CAST(label % 3 AS DOUBLE) AS label", *signs)
    return VectorAssembler(inputCols=[f"s{i}" for i in range(d)], outputCol="features").transform(
        wide).select("id", "label", "features")
