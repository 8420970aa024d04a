"""Stupid-backoff scores of documents under the rest of their corpus.

The score of a word after its context is c(context word) / c(context) if that n-gram occurs
elsewhere, else ALPHA times the score after the context without its first word; at the end
ALPHA^k * c(word) / N.  Counts are those of the whole corpus without the document itself
(its own n-grams would otherwise always be found); a word that occurs nowhere else counts
UNSEEN.  A document's score is the sum of the logarithms.

All of it is a join of exploded n-grams with count tables that are partitioned by hash, in
columnar blocks instead of one row per n-gram:

1. documents are dealt into blocks of about BLOCK_BYTES of text;
2. every block explodes its n-grams, counts them and sends each hash partition the sorted
   distinct hashes and counts of the n-grams that belong there, as one row of two arrays;
3. a hash partition sums the counts (its count table) and joins them back to every row it
   got: one array of the counts in all other blocks;
4. every block adds its own counts, joins them to its exploded n-grams and sums per document.

Orders are taken one after the other, so a block holds the arrays of one order at a time.
Everything travels packed without loss: sorted hashes as their differences in as few bytes as
the largest needs, counts and texts compressed.

A block needs an n-gram once however often it occurs, so a very common n-gram costs a hash
partition one entry per block.  The numbers of blocks and of hash partitions grow with the
text, so tasks stay the same size.  Nothing is collected.

Defined cases.  Null, empty and blank texts have no words, a log-probability of 0 and no
score.  Repeated rows are documents of their own, so each counts for the others.  Words are
lower-cased ASCII letters, digits and other characters; ASCII punctuation separates.  Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import tokens as T

ORDER = 3
ALPHA = 0.4
UNSEEN = 0.5
BLOCK_BYTES = 8 << 20
_PARTITION_WORDS = 1 << 20


def _words(col: pa.Array) -> T.Words:
    return T.Words(col, T.word_table(T.ALNUM_SEPARATORS))


def _grams(w: T.Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes of the n-grams of a block, their counts, for each word the index of the n-gram that ends there or -1)."""
    first, h = w.grams(n)
    distinct, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    at = np.full(len(w.hash), -1, np.int64)
    at[first + n - 1] = inverse
    return distinct, counts, at


def _packed(x: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest needs; the first byte is the width."""
    x = np.ascontiguousarray(x, "<u8")
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    body = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, raw[0])
    out = np.zeros((len(body), 8), np.uint8)
    out[:, :raw[0]] = body
    return out.view("<u8").ravel()


def _squeezed(raw) -> bytes:
    """Length, and the compressed bytes."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unsqueezed(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def _packed_hashes(h: np.ndarray) -> bytes:
    """Sorted distinct hashes: the first one, then the differences."""
    return h[:1].astype("<u8").tobytes() + _packed(np.diff(h))


def _unpacked_hashes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate((np.frombuffer(raw, "<u8", 1), _unpacked(raw[8:]))), dtype=np.uint64)


def _parts(h: np.ndarray, parts: int) -> np.ndarray:
    """First index of every hash partition; partitions are ranges of the sorted hashes."""
    edges = (np.arange(1, parts, dtype=object) * (1 << 64) // parts).astype(np.uint64)
    return np.concatenate(([0], np.searchsorted(h, edges), [len(h)]))


def _squeeze_texts(batches):
    for part in T.chunks(batches):
        raw, off = T.column_bytes(part.column(1))
        texts = [_squeezed(raw[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])]
        yield pa.record_batch({"id": part.column(0), "text": pa.array(texts, pa.binary()), "block": part.column(2)})


def _text(table: pa.Table) -> pa.Array:
    return pa.array([_unsqueezed(x.as_py()) for x in table.column("text")], pa.large_binary())


_REQUEST = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("order", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())])
_REPLY = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("order", pa.int32()), ("counts", pa.binary())])


def _request(order: int, parts: int):
    def run(key, table):
        w = _words(_text(table))
        rows = []
        for n in range(order):
            grams, counts, _ = _grams(w, n + 1)
            cut = _parts(grams, parts)
            for p in np.flatnonzero(np.diff(cut)):
                a, b = cut[p], cut[p + 1]
                rows.append({"part": int(p), "block": key[0].as_py(), "order": n, "grams": _packed_hashes(grams[a:b]), "counts": _squeezed(_packed(counts[a:b]))})
        return pa.Table.from_pylist(rows, _REQUEST)
    return run


def _reply(table):
    rows = []
    for n in sorted(set(table.column("order").to_pylist())):
        r = table.filter(pc.equal(table.column("order"), n))
        grams = [_unpacked_hashes(x.as_py()) for x in r.column("grams")]
        counts = [_unpacked(_unsqueezed(x.as_py())) for x in r.column("counts")]
        _, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        own = np.concatenate(counts).astype(np.int64)
        others = np.bincount(inverse, own).astype(np.int64)[inverse] - own
        ends = np.cumsum([len(x) for x in grams])
        for block, part, a, b in zip(r.column("block").to_pylist(), r.column("part").to_pylist(), ends - [len(x) for x in grams], ends):
            rows.append({"block": block, "part": part, "order": n, "counts": _squeezed(_packed(others[a:b]))})
    return pa.Table.from_pylist(rows, _REPLY)


def _own(doc: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often each (document, n-gram) occurs, for every occurrence."""
    order = np.lexsort((gram, doc))
    d, g = doc[order], gram[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
    run = np.cumsum(new) - 1
    out = np.empty(len(d), np.int64)
    out[order] = np.bincount(run)[run] if len(d) else 0
    return out


def _score(order: int, whole: int):
    def run(left, right):
        w = _words(_text(left))
        size, n_words = left.num_rows, len(w.hash)
        others: list[list] = [[] for _ in range(order)]
        for r in sorted(right.to_pylist(), key=lambda r: (r["order"], r["part"])):
            others[r["order"]].append(r["counts"])
        elsewhere = []                                   # of the n-gram that ends at each word, without its own document
        for n in range(order):
            _, total, at = _grams(w, n + 1)
            if len(total):
                total = total + np.concatenate([_unpacked(_unsqueezed(x)) for x in others[n]]).astype(np.int64)
            have = np.flatnonzero(at >= 0)
            c = np.full(n_words, -1, np.int64)
            c[have] = total[at[have]] - _own(w.doc[have], at[have])
            elsewhere.append(c)
        rest = np.maximum(whole - np.repeat(w.count, w.count), 1)
        log = np.full(n_words, np.nan)
        used = np.zeros(n_words, np.int64)               # length of the n-gram that gave the score
        for n in range(order, 1, -1):
            hit = np.flatnonzero((used == 0) & (elsewhere[n - 1] > 0))
            log[hit] = np.log(elsewhere[n - 1][hit]) - np.log(elsewhere[n - 2][hit - 1])
            used[hit] = n
        hit = np.flatnonzero(used == 0)
        log[hit] = np.log(np.where(elsewhere[0][hit] > 0, elsewhere[0][hit], UNSEEN) / rest[hit])
        used[hit] = 1
        place = np.arange(n_words) - np.repeat(w.first, w.count)
        steps = np.minimum(place + 1, order) - used      # contexts dropped
        log += steps * np.log(ALPHA)
        logprob = np.bincount(w.doc, log, minlength=size).astype(np.float64)
        backed = np.bincount(w.doc, steps > 0, minlength=size).astype(np.int64)
        mean = pa.array(logprob / np.maximum(w.count, 1), mask=w.count == 0)
        return pa.table({"id": left.column("id"), "n_words": pa.array(w.count.astype(np.int64)), "n_backoff": pa.array(backed),
                         "logprob": pa.array(logprob), "score": mean})
    return run


def _sizes(batches):
    table = T.word_table(T.ALNUM_SEPARATORS)
    for part in T.chunks(batches):
        raw, off = T.column_bytes(part.column(0))
        inside = table[T._LOWER[raw]]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        first = off[:-1][off[:-1] < len(raw)]
        start[first] = inside[first]
        yield pa.record_batch({"bytes": pa.array([len(raw)]), "words": pa.array([int(start.sum())])})


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Per document row: id, n_words, n_backoff (words scored after a shorter context), logprob (sum of logarithms), score (their mean)."""
    size, whole = docs.select(F.col(text_col).alias("text")).mapInArrow(_sizes, "bytes long, words long") \
        .agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    blocks = max(1, -(-size // BLOCK_BYTES))
    parts = max(1, -(-whole * order // _PARTITION_WORDS))
    kind = docs.schema[id_col].dataType.simpleString()
    # The partition's number deals rows that are equal in everything to several blocks.
    dealt = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.spark_partition_id()), F.lit(blocks)).cast("int").alias("block")) \
        .mapInArrow(_squeeze_texts, f"id {kind}, text binary, block int")
    asked = dealt.groupBy("block").applyInArrow(_request(order, parts), "part int, block int, `order` int, grams binary, counts binary")
    answered = asked.groupBy("part").applyInArrow(_reply, "block int, part int, `order` int, counts binary")
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        _score(order, whole), f"id {kind}, n_words long, n_backoff long, logprob double, score double")


def op4_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigrams backing off to bigrams and words, every document against all others."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
