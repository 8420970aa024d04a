"""Merkle manifest of a dataset, built by sibling-shift self-joins.

Leaf: sha256 over the named fields of a row, each `-` if null, else its UTF-8 byte count, `:`
and its value.  Every group's leaves, in order, are hashed in runs of FANOUT, level by level,
until one node is left, the group's subroot; the subroots are the leaves of one more tree.

A level is a table (g, i, h, n): group, index, digest, nodes of the group on this level.
Slot-zero nodes compute their siblings' indices (i + 0 .. FANOUT - 1, up to n) and an equijoin
on (g, index) fetches the digests; the slot-zero row then emits the parent i div FANOUT with
the run's digests as one binary.  A group of a third of all rows is so spread as any other:
the keys of the join are single nodes, and what is gathered is one run.

Proofs go down again.  A node's path is the digests left and right of it in its run and then
its parent's path; children find their parent by an equijoin on (g, i div FANOUT), at most
FANOUT to one.  Only parents, a FANOUT-th of the rows, are written with paths; the leaves' own
are folded where they are joined.  Folding starts from any digest, so a changed row is checked
against siblings of the original.

Order needs no single task: leaves are range-partitioned by (group, id, leaf) and sorted; an
index is the place among the group's rows of a partition plus those of the partitions before.
Digests are 32 bytes and become hexadecimal only where they are hashed.  Texts are hashed
before anything is shuffled.

Defined cases.  A null group is the first group, null ids come first in it.  Rows equal in
group, id and leaf are leaves of their own, each with the proof of its place (rows equal in
everything are interchangeable).  A group of one row has its leaf as subroot; a table of one
group has its subroot as root; without siblings the proof is the digest of nothing.  An empty
table gives no rows.  Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

FANOUT = 16
_BYTES = 32
_PATH = "array<struct<l:binary,r:binary>>"


def field(c: Column) -> Column:
    """`-` if null, else byte count, `:` and value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def folded_case(c: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class _Stored:
    """Tables under the checkpoint folder: no lineage, and a lost executor costs nothing finished."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.count = spark, scratch_path(spark, "merkle"), 0

    def put(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)


def _places(batches):
    """Adds `part` and `at`, the place among the partition's rows of the same group (rows come sorted by group)."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        group = batch.column(batch.schema.names.index("g"))
        code = group.dictionary_encode("encode").indices.to_numpy()
        new = np.concatenate(([last != (group[0].as_py(),)], code[1:] != code[:-1]))
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        at = np.arange(n) - first
        at[:n if not new.any() else int(np.argmax(new))] += count
        last, count = (group[n - 1].as_py(),), int(at[-1]) + 1
        yield pa.record_batch([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(at)], names=[*batch.schema.names, "part", "at"])


def indexed(tables: _Stored, rows: DataFrame, order: Sequence[str], names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with number, i and n: index in the group and its size; groups as (number, n)).  `rows` has a column g, `names` (g, number) of each.

    Numbers and offsets come by the pair of group and partition, so a hot group is no hot key.
    """
    spread = rows.withColumn("spread", F.spark_partition_id())            # rows equal in the order are dealt out
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    ordered = spread.repartitionByRange("g", *order, "spread").sortWithinPartitions("g", *order).drop("spread")
    placed = tables.put(ordered.mapInArrow(_places, f"{schema}, part int, at long"))
    counts = placed.groupBy("g", "part").agg(F.count(F.lit(1)).alias("c"))  # a row per group and partition it lies in
    of = Window.partitionBy("g")
    before = counts.select("g", "part", (F.sum("c").over(of.orderBy("part")) - F.col("c")).alias("before"), F.sum("c").over(of).alias("n"))
    before = tables.put(before.alias("b").join(names.alias("m"), F.expr("b.g <=> m.g")).select("b.*", "m.number"))
    joined = placed.alias("p").join(before.alias("b"), F.expr("p.part = b.part AND p.g <=> b.g"))      # null groups match
    out = joined.select("p.*", "b.number", (F.col("before") + F.col("at")).alias("i"), "b.n").drop("part", "at")
    return out, before.groupBy("number").agg(F.max("n").alias("n"))


def parents(level: DataFrame) -> DataFrame:
    """(g, i, h, n, kids): the next level of the groups that have several nodes, from (g, i, h, n)."""
    nodes = level.where("n > 1").select("g", "i", "h", "n")
    zero = nodes.where(f"i % {FANOUT} = 0").select("g", "n", F.expr(f"explode(sequence(i, least(i + {FANOUT}, n) - 1))").alias("i"))
    met = zero.join(nodes.select("g", "i", "h"), ["g", "i"])
    run = met.groupBy("g", F.expr(f"i div {FANOUT}").alias("up"), "n").agg(F.array_sort(F.collect_list(F.struct("i", "h"))).alias("run"))
    kids = F.aggregate("run", F.expr("X''"), lambda acc, x: F.concat(acc, x["h"]))
    return run.select("g", F.col("up").alias("i"), kids.alias("kids"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")) \
        .withColumn("h", F.unhex(F.sha2(_text(F.col("kids")), 256)))


def _text(digests: Column) -> Column:
    """Digests as the hexadecimal text that is hashed."""
    return F.lower(F.hex(digests))


def _own(kids: str, i: str) -> Column:
    """The siblings left and right of node i in its run."""
    return F.expr(f"named_struct('l', substring({kids}, 1, {_BYTES} * cast({i} % {FANOUT} as int)), "
                  f"'r', substring({kids}, {_BYTES} * cast({i} % {FANOUT} + 1 as int) + 1))")


def tree(tables: _Stored, leaves: DataFrame, largest: int) -> list[DataFrame]:
    """The levels above the leaves (g, i, h, n, kids), as stored tables; as many as the largest group needs."""
    levels, level = [], leaves
    while largest > 1:
        level = tables.put(parents(level))
        levels.append(level)
        largest = -(-largest // FANOUT)
    return levels


def with_paths(tables: _Stored, leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Leaves with `path` and the columns of `tops`, one row per group: (g, path, ...), the path above the group's last node."""
    more = [c for c in tops.columns if c not in ("g", "path")]
    below: DataFrame | None = None                       # the level above, with paths
    for level in [*reversed(levels), leaves]:
        own = [c for c in level.columns if c != "g"]
        last = level.where("n = 1").join(tops, "g").select("g", *own, "path", *more)
        if below is None:
            found = last
        else:
            up = below.select("g", F.col("i").alias("up"), F.col("kids").alias("run"), F.col("path").alias("above"), *more)
            met = level.where("n > 1").withColumn("up", F.expr(f"i div {FANOUT}")).join(up, ["g", "up"])
            found = last.unionByName(met.select("g", *own, F.concat(F.array(_own("run", "i")), "above").alias("path"), *more))
        below = found if level is leaves else tables.put(found)
    return below


def proof(path: str) -> Column:
    """Digest of all siblings of a path, left to right, level by level."""
    both = F.aggregate(path, F.expr("X''"), lambda acc, p: F.concat(acc, p["l"], p["r"]))
    return F.sha2(_text(both), 256)


def folded(start: str, path: str) -> Column:
    """The root that a leaf digest and its path lead to."""
    return F.aggregate(path, F.col(start), lambda acc, p: F.unhex(F.sha2(_text(F.concat(p["l"], acc, p["r"])), 256)))


def manifest(rows: DataFrame, group: str, order: str, fields: Sequence[str], other: Column | None = None) -> DataFrame:
    """Per row: id (of the order), grp, leaf, subroot, root (digests), path, and `other` if given: the leaf to fold in its place.

    `other` is a digest computed from the row's columns; null means the leaf itself.
    """
    spark = rows.sparkSession
    tables = _Stored(spark)
    leaf = leaf_digest([F.col(f) for f in fields])
    view = rows.select(F.col(group).alias("grp"), F.col(order).alias("id"), leaf.alias("h"), (F.lit(None).cast("binary") if other is None else other).alias("other"))
    # Groups are numbered in their order, nulls first: a number is a short key, and no null key is joined.
    names = view.select("grp").distinct().withColumn("g", F.lit(0))
    numbered, _ = indexed(tables, names, ["grp"], spark.range(1).select(F.lit(0).alias("g"), F.col("id").alias("number")))
    names = tables.put(numbered.select(F.col("grp").alias("g"), F.col("i").alias("number")))
    leaves, sizes = indexed(tables, view.withColumnRenamed("grp", "g"), ["id", "h"], names)
    leaves = tables.put(leaves.select(F.col("number").alias("g"), F.col("g").alias("grp"), "id", "h", "other", "i", "n"))
    largest, groups = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    levels = tree(tables, leaves, largest)
    last = [t.where("n = 1").select("g", "h") for t in (leaves, *levels)]
    subroots = last[0]
    for t in last[1:]:
        subroots = subroots.unionByName(t)
    subroots = tables.put(subroots.select(F.lit(0).alias("g"), F.col("g").alias("i"), "h", F.lit(groups).cast("long").alias("n")))
    above = tree(tables, subroots, groups)
    root = (above[-1] if above else subroots).where("n = 1").select("g", F.col("h").alias("root"), F.expr(f"cast(array() as {_PATH})").alias("path"))
    tops = with_paths(tables, subroots, above, root).select(F.col("i").alias("g"), F.col("h").alias("subroot"), "root", "path")
    return with_paths(tables, leaves, levels, tables.put(tops)).select("grp", "id", F.col("h").alias("leaf"), "other", "subroot", "root", "path")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, checked for a copy in which some texts are changed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = leaf_digest([folded_case(F.col(f)) if f == "text" else F.col(f) for f in fields])
    other = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, changed)
    out = manifest(docs, "source", "doc_id", fields, other).withColumn("start", F.coalesce("other", "leaf"))
    return out.withColumn("end", folded("start", "path")).select(
        F.col("id").alias("doc_id"), _text(F.col("leaf")).alias("leaf"), _text(F.col("subroot")).alias("subroot"), _text(F.col("root")).alias("root"),
        proof("path").alias("proof_sha256"), _text(F.col("end")).alias("folded_root"), (F.col("end") == F.col("root")).alias("verified"))


_FIELDS = " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}) || ':' || {c} END"
                      for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "{text}"))
#: DuckDB has no crc32: its table-free form runs over the digits of the id.
ORACLE = f"""
WITH RECURSIVE
crc AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS pos, CAST(4294967295 AS UBIGINT) AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, pos + 1, list_reduce(list_prepend(xor(c, CAST(ascii(substr(s, pos + 1, 1)) AS UBIGINT)), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS UBIGINT[])),
    lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN CAST(3988292384 AS UBIGINT) ELSE CAST(0 AS UBIGINT) END))
  FROM crc WHERE pos < length(s)),
tampered AS (SELECT doc_id AS id, xor(c, CAST(4294967295 AS UBIGINT)) % 5 = 0 AS t FROM crc WHERE pos = length(s)),
leaves AS (SELECT d.doc_id, d.source, sha256({_FIELDS.format(text="text")}) AS leaf,
    CASE WHEN t THEN sha256({_FIELDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS other
  FROM documents d LEFT JOIN tampered x ON x.id = d.doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM leaves),
up AS (SELECT g, 0 AS lev, i, leaf AS h, n FROM placed
  UNION ALL
  SELECT g, lev + 1, i // {FANOUT}, sha256(string_agg(h, '' ORDER BY i)), (max(n) + {FANOUT - 1}) // {FANOUT} FROM up WHERE n > 1 GROUP BY g, lev, i // {FANOUT}),
subs AS (SELECT g, h AS subroot, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lev, g AS i, subroot AS h, n FROM subs
  UNION ALL
  SELECT lev + 1, i // {FANOUT}, sha256(string_agg(h, '' ORDER BY i)), (max(n) + {FANOUT - 1}) // {FANOUT} FROM top WHERE n > 1 GROUP BY lev, i // {FANOUT}),
sides AS (SELECT a.g, a.lev, a.i, a.n, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM up a JOIN up b ON b.g = a.g AND b.lev = a.lev AND b.i // {FANOUT} = a.i // {FANOUT} WHERE a.n > 1 GROUP BY a.g, a.lev, a.i, a.n),
top_sides AS (SELECT a.lev, a.i, a.n, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM top a JOIN top b ON b.lev = a.lev AND b.i // {FANOUT} = a.i // {FANOUT} WHERE a.n > 1 GROUP BY a.lev, a.i, a.n),
walk AS (SELECT g, i AS leaf_at, 0 AS lev, i, n, coalesce(other, leaf) AS h, '' AS path FROM placed
  UNION ALL
  SELECT w.g, w.leaf_at, w.lev + 1, w.i // {FANOUT}, (w.n + {FANOUT - 1}) // {FANOUT}, sha256(s.l || w.h || s.r), w.path || s.l || s.r
  FROM walk w JOIN sides s ON s.g = w.g AND s.lev = w.lev AND s.i = w.i WHERE w.n > 1),
climb AS (SELECT w.g, leaf_at, 0 AS lev, w.g AS i, s.n, h, path FROM walk w JOIN subs s ON s.g = w.g WHERE w.n = 1
  UNION ALL
  SELECT c.g, c.leaf_at, c.lev + 1, c.i // {FANOUT}, (c.n + {FANOUT - 1}) // {FANOUT}, sha256(s.l || c.h || s.r), c.path || s.l || s.r
  FROM climb c JOIN top_sides s ON s.lev = c.lev AND s.i = c.i WHERE c.n > 1)
SELECT p.doc_id, p.leaf, s.subroot, t.h AS root, sha256(c.path) AS proof_sha256, c.h AS folded_root, c.h = t.h AS verified
FROM placed p JOIN subs s ON s.g = p.g JOIN climb c ON c.g = p.g AND c.leaf_at = p.i AND c.n = 1 CROSS JOIN (SELECT h FROM top WHERE n = 1) t
"""
