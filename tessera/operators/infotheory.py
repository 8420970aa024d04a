"""Counting and information measures for byte-valued features.

Data layout.  The reference transposes each partition into per-feature byte
columns and persists them.  Spark needs no block layout: the row table
``(x array<tinyint>, y tinyint)`` is persisted once and every count job
explodes it with ``posexplode`` straight into a hash aggregate.  The partial
(map-side) aggregate reduces each task's output to its distinct cells, so
the shuffle carries at most (values x values x classes) cells per feature
per task, whatever the row count, and a hot value or hot class costs no more
than a cold one.

Measures (log base 2), from cells c(k, v, z, y) with marginals taken inside
feature k:

* relevance   I(X_k; Y)     = sum c/n log2(c_vy n / (c_v c_y))
* redundancy  I(X_k; X_j)   = sum c/n log2(c_vz n / (c_v c_z))
* conditional I(X_k; X_j|Y) = sum c/n log2(c c_y / (c_vy c_zy))

where z is the value of the last selected feature j in the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import entropy as E

CELL_KEYS = ("k", "v", "z", "y")


# --------------------------------------------------------------------------- dense

def long_form(df: DataFrame, x: str = "x", y: str = "y", id_col: str | None = None) -> DataFrame:
    """One row per (row, feature): (id?, y, k, v)."""
    cols = ([F.col(id_col).alias("id")] if id_col else []) + [F.col(y).alias("y")]
    return df.select(*cols, F.posexplode(x).alias("k", "v"))


def dense_cells(df: DataFrame, x: str = "x", y: str = "y", given: int | None = None) -> DataFrame:
    """Cells (k, v, z, y, c).  ``z`` is x[given], or 0 when no feature is given."""
    z = f"{x}[{int(given)}]" if given is not None else "CAST(0 AS TINYINT)"
    exploded = df.selectExpr(f"{y} AS y", f"{z} AS z", f"posexplode({x}) AS (k, v)")
    return exploded.groupBy(*CELL_KEYS).agg(F.expr("count(1) AS c"))


def dense_cells_many(df: DataFrame, given: list[int], x: str = "x", y: str = "y", only: list[int] | None = None) -> DataFrame:
    """Cells (j, k, v, z, y, c) against every feature j in ``given`` in ONE pass; of the features in ``only`` if given.

    Each row is exploded over its features and over the |given| reference
    features, so one scan serves several selection runs in lockstep.
    """
    refs = ", ".join(f"named_struct('j', {int(j)}, 'z', {x}[{int(j)}])" for j in given)
    if only is None:
        exploded = df.selectExpr(f"{y} AS y", f"explode(array({refs})) AS g", f"posexplode({x}) AS (k, v)")
    else:
        some = ", ".join(f"named_struct('k', {int(k)}, 'v', {x}[{int(k)}])" for k in only)
        exploded = df.selectExpr(f"{y} AS y", f"explode(array({refs})) AS g", f"inline(array({some})) AS (k, v)")
    return (exploded.selectExpr("g.j AS j", "k", "v", "g.z AS z", "y")
            .groupBy("j", *CELL_KEYS).agg(F.expr("count(1) AS c")))


# -------------------------------------------------------------------------- sparse

def class_totals_of(rows: DataFrame) -> list[tuple[int, int]]:
    """(y, count) per class.  Bounded: labels are bytes (at most 256 classes)."""
    return [(int(r["y"]), int(r["n"])) for r in
            rows.groupBy("y").agg(F.expr("count(1) AS n")).collect()]


class_totals = class_totals_of


def _grid(spark, n_features: int, pairs: list[tuple[int, int, int]]) -> DataFrame:
    """(k, z, y, total) for every feature k and every (z, y, total) in ``pairs``.

    ``pairs`` is bounded by the byte domain (<= 256 x 256 entries), so it
    travels as a literal; the feature axis is a distributed range.
    """
    lit = F.array(*[F.struct(F.lit(z).cast("tinyint").alias("z"), F.lit(y).cast("tinyint").alias("y"),
                             F.lit(t).cast("long").alias("t")) for z, y, t in pairs])
    return (spark.range(n_features).select(F.col("id").cast("int").alias("k"),
                                           F.explode(lit).alias("g"))
            .select("k", "g.z", "g.y", "g.t"))


def joint_totals(entries: DataFrame, rows: DataFrame, given: list[int],
                 class_totals: list[tuple[int, int]]) -> dict[int, list[tuple[int, int, int]]]:
    """(z, y, count) of every reference feature j in ``given``, zeros included, in ONE job.

    The non-zero part is a partially aggregated count of j's entries; the z = 0
    part is the class total minus it.  Bounded: |given| x 256 x classes rows.
    """
    want = ", ".join(str(int(j)) for j in given)
    counted = (entries.where(f"k IN ({want})")
               .groupBy("k", F.col("v").alias("z"), "y").agg(F.expr("count(1) AS n")).collect())
    out: dict[int, list[tuple[int, int, int]]] = {int(j): [] for j in given}
    for r in counted:
        out[int(r["k"])].append((int(r["z"]), int(r["y"]), int(r["n"])))
    for j, cells in out.items():
        for y, n in class_totals:
            rest = n - sum(c for z, yy, c in cells if yy == y)
            if rest > 0:
                cells.append((0, y, rest))
    return out


def sparse_cell_parts(entries: DataFrame, rows: DataFrame, n_features: int,
                      given: int | None = None, class_totals: list[tuple[int, int]] | None = None,
                      joint: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """A13 in two parts: non-zero cells plus one TOTAL row per (k, z, y).

    Columns (k, v, z, y, c, is_total).  A total row carries c(z, y) over all
    rows; the zero cell is that total minus the feature's non-zero cells,
    c(k,0,z,y) = c(z,y) - sum_{v!=0} c(k,v,z,y).  ``information`` completes the
    zero cells inside the per-feature partition it already creates, so the
    sparse path adds no join, no broadcast and no second aggregation.

    ``entries``: (id, y, k, v) with v != 0; ``rows``: (id, y) for every row.
    For ``given`` = j the value z of feature j joins on the row id; with
    ``entries`` partitioned by id once (``partition_entries``) that join needs
    no shuffle.  Pass ``class_totals`` / ``joint`` when known to skip their
    (small) jobs.
    """
    spark = entries.sparkSession
    totals = class_totals if class_totals is not None else class_totals_of(rows)
    if given is None:
        nz = entries.selectExpr("k", "v", "CAST(0 AS TINYINT) AS z", "y")
        joint = [(0, y, n) for y, n in totals]
    else:
        zcol = entries.where(f"k = {int(given)}").selectExpr("id", "v AS z")
        nz = (entries.join(zcol, "id", "left")
              .selectExpr("k", "v", "coalesce(z, CAST(0 AS TINYINT)) AS z", "y"))
        if joint is None:
            joint = joint_totals(entries, rows, [int(given)], totals)[int(given)]
    nz_cells = nz.groupBy(*CELL_KEYS).agg(F.expr("count(1) AS c")).selectExpr(
        "k", "v", "z", "y", "c", "false AS is_total")
    grand = _grid(spark, n_features, joint).selectExpr(
        "k", "CAST(NULL AS TINYINT) AS v", "z", "y", "t AS c", "true AS is_total")
    return nz_cells.unionByName(grand)


def complete_zero_cells(parts: DataFrame, keys: tuple[str, ...] = ("k",)) -> DataFrame:
    """Turn TOTAL rows into zero cells: (keys..., v, z, y, c) with c > 0 only.

    Runs per (keys, z, y) window; call it on data already partitioned by ``keys``
    (``information`` does) and it needs no exchange of its own.
    """
    part = ", ".join((*keys, "z", "y"))
    filled = parts.selectExpr(
        *keys, "v", "z", "y", "c", "is_total",
        f"sum(CASE WHEN is_total THEN 0 ELSE c END) OVER (PARTITION BY {part}) AS nz")
    return filled.selectExpr(
        *keys, "CASE WHEN is_total THEN CAST(0 AS TINYINT) ELSE v END AS v", "z", "y",
        "CASE WHEN is_total THEN c - nz ELSE c END AS c").where("c > 0")


def sparse_cells(entries: DataFrame, rows: DataFrame, n_features: int,
                 given: int | None = None, class_totals: list[tuple[int, int]] | None = None,
                 joint: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """The same cells as ``dense_cells`` from non-zero entries only (explicit zeros)."""
    parts = sparse_cell_parts(entries, rows, n_features, given, class_totals, joint)
    return complete_zero_cells(parts.repartition("k")).select(*CELL_KEYS, "c")


def sparse_cells_many(entries: DataFrame, rows: DataFrame, n_features: int,
                      given: list[int], class_totals: list[tuple[int, int]] | None = None) -> DataFrame:
    """Cell parts (j, k, v, z, y, c, is_total) for every j in ``given``: one join, one job.

    The values of the reference features become one small map per row id
    (|given| entries at most), joined once; with ``entries`` partitioned by id
    neither the map nor the join shuffles.
    """
    totals = class_totals if class_totals is not None else class_totals_of(rows)
    joints = joint_totals(entries, rows, given, totals)
    wanted = ", ".join(str(int(j)) for j in given)
    refs = entries.where(f"k IN ({wanted})").groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("zs"))
    nz = (entries.join(refs, "id", "left")
          .selectExpr(f"explode(array({wanted})) AS j", "k", "v", "y", "zs")
          .selectExpr("j", "k", "v", "coalesce(zs[j], CAST(0 AS TINYINT)) AS z", "y"))
    cells = nz.groupBy("j", *CELL_KEYS).agg(F.expr("count(1) AS c")).selectExpr(
        "j", "k", "v", "z", "y", "c", "false AS is_total")
    for j in given:
        grand = _grid(entries.sparkSession, n_features, joints[int(j)]).selectExpr(
            f"{int(j)} AS j", "k", "CAST(NULL AS TINYINT) AS v", "z", "y", "t AS c", "true AS is_total")
        cells = cells.unionByName(grand)
    return cells


def partition_entries(entries: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition non-zero entries by row id (reused by every round's join).

    The count is explicit (default: the cluster's default parallelism): a
    persisted plan keeps its shuffle width, AQE does not coalesce it later.
    """
    n = num_partitions or entries.sparkSession.sparkContext.defaultParallelism
    return entries.repartition(int(n), "id")


# --------------------------------------------------------------------- measures

def information(cells: DataFrame, keys: tuple[str, ...] = ("k",)) -> DataFrame:
    """(keys..., rel, mi, cmi) from cells (keys..., v, z, y, c).

    The cell table is small (bounded by the value domains); it is hash
    partitioned on the keys once, which satisfies every marginal window
    below, so no further shuffle happens before the final per-key sum.
    Sparse cell parts (with ``is_total`` rows) get their zero cells filled in
    that same partitioning.
    """
    sparse = "is_total" in cells.columns
    cols = (*keys, "v", "z", "y", "CAST(c AS DOUBLE) AS c") + (("is_total",) if sparse else ())
    base = cells.selectExpr(*cols).repartition(*keys)
    if sparse:
        base = complete_zero_cells(base, keys)
    m = base
    for name, window in E.marginal_windows(keys):
        m = m.selectExpr("*", f"{window} AS {name}")
    return m.groupBy(*keys).agg(F.expr(f"sum({E.RELEVANCE_TERM}) AS rel"),
                                F.expr(f"sum({E.REDUNDANCY_TERM}) AS mi"),
                                F.expr(f"sum({E.CONDITIONAL_TERM}) AS cmi"))


def relevance(cells: DataFrame) -> DataFrame:
    """A10: (k, mi) = I(X_k; Y)."""
    return information(cells).select("k", F.col("rel").alias("mi"))


def redundancy(cells: DataFrame) -> DataFrame:
    """(k, mi, cmi) = (I(X_k; X_j), I(X_k; X_j | Y)) for the given j."""
    return information(cells).select("k", "mi", "cmi")


def clean(col: Column, digits: int = 6) -> Column:
    """Round for reporting; adding 0.0 turns -0.0 into 0.0."""
    return F.round(col, digits) + F.lit(0.0)


# ----------------------------------------------------------------- column layout

def columnar_layout(entries: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """A8 re-aimed: the non-zero long form (k, id, v) laid out feature-major.

    Range partitioning on (k, id) keeps each feature's cells contiguous and
    sorted by row while still splitting a feature that holds many non-zeros
    across partitions (no single task owns a hot feature).
    """
    cols = ["k", "id"]
    ranged = (entries.repartitionByRange(num_partitions, *cols) if num_partitions
              else entries.repartitionByRange(*cols))
    return ranged.sortWithinPartitions(*cols)


def column_summary(entries: DataFrame) -> DataFrame:
    """Per feature: number of non-zeros and sum(id * v), one partial-aggregated pass."""
    return entries.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_nonzero"),
        F.sum(F.col("id").cast("bigint") * F.col("v").cast("bigint")).alias("checksum"))
