"""Language identification as inference of a multilingual mixture.

Every language has a distribution of byte trigrams inside words (a word's ends count as a
byte of their own), counted over all training documents.  A word's likelihood in a language
is the product over its trigrams.  A document is a mixture: each word is drawn from one
language, and expectation-maximisation estimates the proportions.  The set of languages is
chosen by penalised likelihood: languages are taken out, the weakest first, as long as the
log-likelihood falls by less than the penalty PENALTY * log(words) / 2 that each one costs.
The prediction is the language with the largest proportion, the score that proportion.

Counts are combined in the tasks; the model is a table of languages x 2^GRAM_BITS numbers,
and more than MAX_LANGUAGES languages are an error, so its size is bounded.  Prediction reads
whole texts without a shuffle; all documents of a batch go through EM together.

Defined cases.  Null texts and texts without a letter are `und` with score 0, as is every
text if nothing was learnt.  Ties go to the language that sorts first.  A document without
language, id or text teaches nothing.  A null id is not held out.  Repeated rows count as
often as they occur.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import tokens as T

GRAM_BITS = 16
MAX_LANGUAGES = 200
SMOOTHING = 0.5
STEPS = 12
PENALTY = 2.0
_CHUNK = 2 << 20

_LETTERS = T.word_table([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = np.where(_LETTERS, np.arange(256), 0).astype(np.uint8)
_FOLD[65:91] += 32


def trigrams(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed trigram around every word byte, first trigram of every word, row of every word)."""
    raw, off = T.column_bytes(col)
    fold = _FOLD[raw].astype(np.uint32)
    before, after = np.zeros(len(raw), np.uint32), np.zeros(len(raw), np.uint32)
    before[1:], after[:-1] = fold[:-1], fold[1:]
    before[off[:-1][off[:-1] < len(raw)]] = 0
    after[off[1:][off[1:] > 0] - 1] = 0
    at = np.flatnonzero(fold)
    h = (before[at] << np.uint32(16)) | (fold[at] << np.uint32(8)) | after[at]
    h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)
    first = np.flatnonzero(before[at] == 0)
    return h, first, np.searchsorted(off, at[first], "right") - 1


def _counts(languages: list[str]):
    def run(batches):
        size = 1 << GRAM_BITS
        total = np.zeros((len(languages), size), np.int64)
        code = {name: i for i, name in enumerate(languages)}
        for part in T.chunks(batches):
            lang = np.array([code[x] for x in part.column(0).to_pylist()])
            h, first, row = trigrams(part.column(1))
            each = np.repeat(lang[row], np.diff(np.append(first, len(h))))
            total += np.bincount(each * size + h, minlength=total.size).reshape(total.shape)
        lang, gram = np.nonzero(total)
        yield pa.record_batch({"lang": pa.array(lang), "gram": pa.array(gram), "n": pa.array(total[lang, gram])})
    return run


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", keep: Column | None = None) -> tuple[list[str], np.ndarray]:
    """(languages in order, log-probability of each trigram by language)."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.where(keep) if keep is not None else known
    languages = sorted(r[0] for r in known.select(lang_col).distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(_counts(languages), "lang long, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()            # at most MAX_LANGUAGES * 2^GRAM_BITS rows
    table = np.full((len(languages), 1 << GRAM_BITS), SMOOTHING)
    table[counts.lang.to_numpy(), counts.gram.to_numpy()] += counts.n.to_numpy()
    return languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32) if languages else table.astype(np.float32)


def _em(like: np.ndarray, shift: np.ndarray, row: np.ndarray, start: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) per row, over the active languages; rows without words are not given."""
    n = np.diff(np.append(start, len(row))).astype(np.float32)[:, None]
    theta = active / active.sum(axis=1, keepdims=True, dtype=np.float32)
    for step in range(STEPS + 1):
        part = like * theta[row]
        whole = part.sum(axis=1)
        if step == STEPS:
            return theta, np.add.reduceat(np.log(np.maximum(whole, 1e-37)) + shift, start, dtype=np.float64)
        part /= np.maximum(whole, 1e-37)[:, None]
        theta = np.add.reduceat(part, start, axis=0) / n
        theta = np.where(active, theta + 1e-9, 0).astype(np.float32)
        theta /= theta.sum(axis=1, keepdims=True)


def mixtures(col: pa.Array, table: np.ndarray) -> np.ndarray:
    """Language proportions of every row of a text column (0 for rows without words)."""
    h, first, row = trigrams(col)
    out = np.zeros((len(col), len(table)), np.float32)
    if not len(first) or not len(table):
        return out
    words = np.stack([np.add.reduceat(t[h], first) for t in table], axis=1)
    shift = words.max(axis=1)
    like = np.exp(words - shift[:, None])
    docs, start, row = *np.unique(row, return_index=True), np.unique(row, return_inverse=True)[1]
    active = np.ones((len(docs), len(table)), bool)
    theta, ll = _em(like, shift, row, start, active)
    cost = PENALTY * np.log(np.maximum(np.diff(np.append(start, len(row))), 2)) / 2
    open_ = np.arange(len(docs))                              # rows whose set may still shrink
    while len(open_ := open_[active[open_].sum(axis=1) > 1]):
        less = active[open_].copy()
        weak = np.where(less, theta[open_], np.inf)
        less[np.arange(len(open_)), weak.shape[1] - 1 - weak[:, ::-1].argmin(axis=1)] = False     # of equals the last one
        words_open = np.isin(row, open_)
        renamed = np.searchsorted(open_, row[words_open])
        begins = np.searchsorted(renamed, np.arange(len(open_)))
        new_theta, new_ll = _em(like[words_open], shift[words_open], renamed, begins, less)
        better = new_ll + cost[open_] >= ll[open_]
        won = open_[better]
        active[won], theta[won], ll[won] = less[better], new_theta[better], new_ll[better]
        open_ = won
    out[docs] = theta
    return out


def _predict(languages: list[str], model):
    def run(batches):
        for part in T.chunks(batches, limit=_CHUNK):
            theta = mixtures(part.column(1), model.value)
            best = theta.argmax(axis=1) if languages else np.zeros(part.num_rows, int)
            score = theta[np.arange(part.num_rows), best] if languages else np.zeros(part.num_rows)
            raw, off = T.column_bytes(part.column(1))
            plain = np.concatenate((np.zeros(1, np.int64), np.cumsum(_LETTERS[raw] & (raw < 128))))
            plain = plain[off[1:]] > plain[off[:-1]]
            named = [bool(languages) and bool(p or any(c.isalpha() for c in part.column(1)[i].as_py() or "")) for i, p in enumerate(plain)]
            yield pa.record_batch({"id": part.column(0), "lang": pa.array([languages[b] if k else "und" for b, k in zip(best, named)], pa.string()),
                                   "score": pa.array(np.where(named, np.clip(score, 0, 1), 0).astype(np.float64))})
    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    table = docs.sparkSession.sparkContext.broadcast(model[1])       # bounded: see the module's text
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_predict(model[0], table), f"id {kind}, lang string, score double")


def _quarter(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 4


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from three quarters of the documents, predicts all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, keep=_quarter() != 2)
    return identify(docs, model).select(F.col("id").alias("doc_id"), F.coalesce(_quarter("id") == 2, F.lit(False)).alias("held_out"),
                                        F.col("lang").alias("lang_pred"), "score")
