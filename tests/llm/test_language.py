"""Language mixtures."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import language as L
from tests.conftest import SF_SMALL

EN = "the cat and the dog went with them to the house that they thought was theirs "
DE = "der hund und die katze gingen zusammen nach hause weil sie dachten dass es schon spät ist "


def trained(spark, **kw):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de", 1.0) for i in range(60)] + [(90, "nothing", None, 1.0), (91, None, "xx", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    return L.train(df, **kw)


def test_mixture_proportions(spark):
    names, table = trained(spark)
    assert names == ["de", "en"]
    theta = L.mixtures(pa.array([EN, DE, EN + DE, None, "123 ?!", EN * 3 + DE]), table)
    assert theta[0].argmax() == 1 and theta[1].argmax() == 0
    assert theta[0][1] > 0.999 and theta[1][0] > 0.999         # the other language is taken out
    words = len(EN.split()) / len((EN + DE).split())
    assert abs(theta[2][1] - words) < 0.15
    assert not theta[3].any() and not theta[4].any()
    assert abs(theta[5][1] - 3 * len(EN.split()) / (3 * len(EN.split()) + len(DE.split()))) < 0.15


def test_batches_do_not_change_a_result(spark):
    _, table = trained(spark)
    texts = [EN, "", DE, EN + DE, "a", "ß", None, DE * 40]
    alone = np.concatenate([L.mixtures(pa.array([t], pa.string()), table) for t in texts])
    assert np.allclose(alone, L.mixtures(pa.array(texts, pa.string()), table), atol=1e-5)


def test_cases(spark):
    model = trained(spark)
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "— … 。"), (5, "schon"), (6, EN * 3000), (7, EN), (7, EN), (None, DE)]
    got = [(r.id, r.lang, r.score) for r in L.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()]
    assert [g[:2] for g in got] == [(1, "und"), (2, "und"), (3, "und"), (4, "und"), (5, "de"), (6, "en"), (7, "en"), (7, "en"), (None, "de")]
    assert L.identify(spark.createDataFrame([(1, "ß")], "doc_id long, text string"), model).first().lang in ("de", "en")      # a letter, never seen
    assert all(0 <= s <= 1 and (s == 0) == (lang == "und") for _, lang, s in got)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    none = L.train(empty)
    assert none[0] == [] and [r.lang for r in L.identify(spark.createDataFrame(rows, "doc_id long, text string"), none).collect()] == ["und"] * 9
    assert L.identify(empty, model).count() == 0


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="languages"):
        trained(spark)


def test_query(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = L.op2_language_id(spark, SF_SMALL).collect()
    assert len(got) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(docs[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def plain_words(text: str) -> list[list[int]]:
    """Hashed trigrams of every word, byte by byte."""
    folded = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    out = []
    for word in re.findall(rb"[a-z\x80-\xff]+", folded):
        padded = b"\0" + word + b"\0"
        out.append([((padded[i] << 16 | padded[i + 1] << 8 | padded[i + 2]) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - L.GRAM_BITS) for i in range(len(word))])
    return out


def plain_mixture(text: str, table) -> list[float]:
    """Proportions by EM in plain loops, languages taken out one by one."""
    words, count = plain_words(text), len(table)
    if not words:
        return [0.0] * count
    logs = [[sum(float(table[g][t]) for t in w) for g in range(count)] for w in words]

    def em(active):
        theta = [1 / len(active) if g in active else 0.0 for g in range(count)]
        for step in range(L.STEPS + 1):
            parts, ll = [], 0.0
            for log in logs:
                top = max(log)
                p = [math.exp(x - top) * t for x, t in zip(log, theta)]
                ll += math.log(max(sum(p), 1e-37)) + top
                parts.append([x / max(sum(p), 1e-37) for x in p])
            if step == L.STEPS:
                return theta, ll
            theta = [sum(p[g] for p in parts) / len(parts) + 1e-9 if g in active else 0.0 for g in range(count)]
            theta = [t / sum(theta) for t in theta]

    active = set(range(count))
    theta, ll = em(active)
    while len(active) > 1:
        weak = min(active, key=lambda g: (theta[g], -g))
        new, new_ll = em(active - {weak})
        if new_ll + L.PENALTY * math.log(max(len(words), 2)) / 2 < ll:
            break
        active, theta, ll = active - {weak}, new, new_ll
    return theta


def test_mixtures_equal_plain_loops():
    rnd = random.Random(11)
    letters = ["abcde", "defgh", "ghiaé", "xyzab"]
    word = lambda g: "".join(rnd.choice(letters[g]) for _ in range(rnd.randint(2, 6)))
    table = np.full((4, 1 << L.GRAM_BITS), 0.5)
    for g in range(4):
        for w in plain_words(" ".join(word(g) for _ in range(400))):
            for t in w:
                table[g][t] += 1
    table = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    texts = [" ".join(word(rnd.choice(some)) for _ in range(rnd.randint(1, 40))) for some in ([0], [1], [2, 3], [0, 3], [0, 1, 2, 3]) for _ in range(8)]
    texts += ["", "1 2 3", "É é", "abc", "Abc ABC abc"]
    got = L.mixtures(pa.array(texts), table)
    for text, theta in zip(texts, got):
        want = plain_mixture(text, table)
        assert np.allclose(theta, want, atol=2e-3), text
        assert int(np.argmax(theta)) == int(np.argmax(want)), text
