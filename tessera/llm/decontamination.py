"""Benchmark decontamination by a prefix-filtered join with exact verification.

A window is `window` consecutive words of a benchmark item (an item with fewer words, but
not none, is one window).  A document word is hit if it lies inside an occurrence of a
window.  A window occurs only where all of its shingles occur, so one of them is a
necessary prefix token; the rarest is chosen:

1. shingle the items' windows; a bitset of fixed size marks the shingles' hashes;
2. count in how many documents each of them occurs (counts are combined in the tasks);
3. keep each window's rarest shingle with its offset in the window;
4. join the documents' occurrences of those shingles with the windows by hash; a window
   must begin and end inside the document (positional and length bounds), and its words
   must equal the document's words there (exact containment);
5. merge the occurrences of a document into hit words and items.

The bitsets are the only broadcast data; their size is a parameter, whatever the size of
the benchmark (a fuller bitset only lets more rows reach the join).

Defined cases.  Null or empty text has no words: nothing is hit, such an item never
occurs.  Items with a null id name nothing and are left out.  Rows that repeat a document
id are judged each by its own text; repeated items count once.  Empty tables give no
contamination.  Columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import tokens as T
from tessera.llm.bitset import BITS, bitset, marked
from tessera.session import scratch_path

WINDOW = 10
SHINGLE = 3


def _item_windows(window: int, shingle: int):
    def run(batches):
        table = T.word_table(T.ALNUM_SEPARATORS)
        for part in T.chunks(batches):
            ids = part.column(0).to_pylist()
            w = T.Words(part.column(1), table)
            rows: dict[str, list] = {k: [] for k in ("item", "win", "n", "hash", "off")}
            for i, name in enumerate(ids):
                a, n = int(w.first[i]), int(w.count[i])
                size = min(window, n)
                s = min(shingle, size)
                if not s:
                    continue
                hashes = T.sequence_hash(w.hash, np.arange(a, a + n - s + 1), s).view(np.int64)
                for k in range(n - size + 1):
                    text = w.words(a + k, a + k + size)
                    for off in range(size - s + 1):
                        for key, v in zip(rows, (name, text, size, int(hashes[k + off]), off)):
                            rows[key].append(v)
            yield pa.record_batch({"item": pa.array(rows["item"], pa.string()), "win": pa.array(rows["win"], pa.string()),
                                   "n": pa.array(rows["n"], pa.int32()), "hash": pa.array(rows["hash"], pa.int64()),
                                   "off": pa.array(rows["off"], pa.int32())})
    return run


def _document_frequency(widths: list[int], bits):
    def run(batches):
        table = T.word_table(T.ALNUM_SEPARATORS)
        for part in T.chunks(batches):
            w = T.Words(part.column(1), table)
            for s in widths:
                at, h = w.grams(s)
                hit = marked(h, bits.value)
                order = np.lexsort((h[hit], w.doc[at[hit]]))
                d, h = w.doc[at[hit]][order], h[hit][order]
                new = np.ones(len(h), bool)
                new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
                hashes, df = np.unique(h[new], return_counts=True)
                yield pa.record_batch({"hash": T.signed(hashes), "df": pa.array(df.astype(np.int64))})
    return run


def _occurrences(widths: list[int], bits, window: int):
    """One row per document: words, and its prefix tokens with the words around each."""
    def run(batches):
        table = T.word_table(T.ALNUM_SEPARATORS)
        for part in T.chunks(batches):
            w = T.Words(part.column(1), table)
            doc, pos, hashes, left, around = [], [], [], [], []
            for s in widths:
                at, h = w.grams(s)
                hit = marked(h, bits.value)
                for a, v in zip(at[hit], h[hit].view(np.int64)):
                    d = int(w.doc[a])
                    p = int(a - w.first[d])
                    lo, hi = max(0, p + s - window), min(int(w.count[d]), p + window)
                    doc.append(d), pos.append(p), hashes.append(int(v)), left.append(lo)
                    around.append(w.words(w.first[d] + lo, w.first[d] + hi))
            order = np.argsort(np.array(doc, np.int64), kind="stable")
            off = np.searchsorted(np.array(doc, np.int64)[order], np.arange(part.num_rows + 1))
            take = pa.array(order)
            hits = pa.StructArray.from_arrays(
                [pa.array(pos, pa.int32()).take(take), pa.array(hashes, pa.int64()).take(take),
                 pa.array(left, pa.int32()).take(take), pa.array(around, pa.string()).take(take)],
                ["pos", "hash", "lo", "words"])
            yield pa.record_batch({"id": part.column(0), "copy": part.column(2), "n_words": pa.array(w.count.astype(np.int64)),
                                   "hits": pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), hits)})
    return run


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       shingle: int = SHINGLE, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(one row per document row: id, copy, n_words; one row per occurrence: id, copy, start, n, item).

    `copy` is a hash of the text that tells apart rows repeating an id.
    """
    spark = docs.sparkSession
    base = scratch_path(spark, "decontamination")
    (items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("item is not null")
     .mapInArrow(_item_windows(window, shingle), "item string, win string, n int, hash long, off int")
     .write.parquet(f"{base}/windows"))
    windows = spark.read.parquet(f"{base}/windows")
    widths = sorted(r[0] for r in windows.select(F.least("n", F.lit(shingle)).alias("s")).distinct().collect())

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    df = (texts.mapInArrow(_document_frequency(widths, bitset(spark, windows, bits)), "hash long, df long")
          .groupBy("hash").agg(F.sum("df").alias("df")))
    tokens = (windows.select("win", "n", "hash", "off").distinct().join(df, "hash")
              .groupBy("win", "n").agg(F.min(F.struct("df", "hash", "off")).alias("rare"))
              .select("win", "n", "rare.hash", "rare.off"))
    tokens.write.parquet(f"{base}/tokens")
    tokens = spark.read.parquet(f"{base}/tokens")

    kind = docs.schema[id_col].dataType.simpleString()
    (texts.withColumn("copy", F.xxhash64("text"))
     .mapInArrow(_occurrences(widths, bitset(spark, tokens, bits), window),
                 f"id {kind}, copy long, n_words long, hits array<struct<pos:int,hash:long,lo:int,words:string>>")
     .write.parquet(f"{base}/documents"))
    rows = spark.read.parquet(f"{base}/documents")

    hits = rows.where("size(hits) > 0").select("id", "copy", "n_words", F.explode("hits").alias("hit")) \
        .select("id", "copy", "n_words", "hit.*")
    found = (hits.join(tokens, "hash").withColumn("start", F.expr("pos - off"))
             .where("start >= 0 and start + n <= n_words")
             .where("array_join(slice(split(words, ' '), start - lo + 1, n), ' ') = win")
             .select("id", "copy", "start", "n", "win"))
    found = found.join(windows.select("win", "item").distinct(), "win").select("id", "copy", "start", "n", "item")
    return rows.select("id", "copy", "n_words"), found


def contamination_report(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """Per document row: id, n_words, n_hit, n_items, items (sorted ids, comma-joined), contaminated."""
    rows, found = find_contamination(docs, items, **params)
    before = Window.partitionBy("id", "copy").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    covered = (found.select("id", "copy", "start", "n").distinct()
               .withColumn("done", F.coalesce(F.max(F.expr("start + n")).over(before), F.lit(0)))
               .groupBy("id", "copy").agg(F.sum(F.expr("greatest(0, start + n - greatest(start, done))")).alias("n_hit")))
    named = (found.groupBy("id", "copy").agg(F.sort_array(F.collect_set("item")).alias("items"))
             .select("id", "copy", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items")))
    return (_join(rows, _join(covered, named), "left")
            .select("id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.lit("")).alias("items"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))


def _join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on (id, copy), null ids being equal."""
    r = right.withColumnsRenamed({"id": "r_id", "copy": "r_copy"})
    return left.join(r, left["id"].eqNullSafe(r["r_id"]) & left["copy"].eqNullSafe(r["r_copy"]), how).drop("r_id", "r_copy")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The documents in whose texts no window occurs, with all their columns."""
    _, found = find_contamination(docs, items, id_col=id_col, text_col=text_col, **params)
    bad = found.select("id", "copy").distinct().withColumnsRenamed({"id": "__bad_id", "copy": "__bad_copy"})
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__bad_id"]) & F.xxhash64(docs[text_col]).eqNullSafe(bad["__bad_copy"]), "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item, windows of 10 words."""
    report = contamination_report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return report.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
                         F.sha2("items", 256).alias("items_sha256"), "contaminated")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS t
        FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, k, s.n, array_to_string(w[k : k + s.n - 1], ' ') AS t
        FROM d, sizes s, unnest(range(1, len(w) - s.n + 2)) AS u(k) WHERE len(w) >= s.n),
m AS (SELECT o.doc_id, o.k, o.n, x.item FROM occ o JOIN win x ON o.n = x.n AND o.t = x.t),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM m GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
