"""License rules against plain regular expressions without a gate."""

import random
import re

import pytest

from tessera.llm import licenses as L
from tests.conftest import SF_SMALL
from tests.llm import plain


@pytest.fixture(scope="module")
def scanner():
    return L.Scanner(L._rules())


def base_places(text):
    """(words, [(first word, label)]) by comparing words."""
    words, out = plain.alnum_words(text), []
    for phrase, label in L.BASE:
        p = phrase.split()
        out += [(k, label) for k in range(len(words) - len(p) + 1) if words[k:k + len(p)] == p]
    return len(words), sorted(out)


RULES = [(r, re.compile(f"(?<= )(?:{r.pattern})(?= )")) for r in L._rules()]


def ungated(text):
    """Kept detections by trying every rule and comparing all intervals."""
    folded = " " + " ".join(plain.alnum_words(text)) + " "
    found = []
    for i, (r, rule) in enumerate(RULES):
        for m in rule.finditer(folded):
            found.append((folded[:m.start()].count(" ") - 1, folded[:m.end()].count(" "), i, r))
    kept = []
    for s, e, i, r in sorted(found, key=lambda x: (L.TIERS.index(x[3].tier), x[0] - x[1], x[2])):
        if not any(a <= s and e <= b for a, b, _ in kept):
            kept.append((s, e, r))
    return sorted([(s, e, r.tier, r.label) for s, e, r in kept]
                  + [(s, s + len(dict((v, k) for k, v in L.BASE)[label].split()), "base", label) for s, label in base_places(text)[1]])


SAMPLES = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-or-later",
    "see https://creativecommons.org/licenses/by-sa/4.0/ and https://opensource.org/licenses/MIT", "gplv3", "GPL v2", "# SPDX-License-Identifier: (MIT)",
    "under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; version 2.1",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    "ich fahre mit Lizenz", "mit licence", "cc-by-nc cc-by-nc", "a BSD style license", "the Unlicense", "Creative Commons Attribution-ShareAlike 3.0",
]


def test_there_are_hundreds_of_rules_and_each_matches(scanner):
    assert len(scanner.rules) > 300
    for tier in L.TIERS:
        assert any(r.tier == tier for r in scanner.rules)


@pytest.mark.parametrize("text, labels", [
    (SAMPLES[0], {"apache-2", "apache-2.0"}), (SAMPLES[1], {"mit"}), (SAMPLES[2], {"cc-by-nc", "cc-by-nc-4.0"}), (SAMPLES[3], {"gpl-3.0"}),
    (SAMPLES[4], {"lgpl-2.1"}), (SAMPLES[5], {"cc-by-sa-4.0", "mit"}), (SAMPLES[6], {"gpl-3.0"}), (SAMPLES[7], {"gpl-2.0"}), (SAMPLES[8], {"mit"}),
    (SAMPLES[9], {"lgpl-2.1"}), (SAMPLES[10], {"bsd-3-clause"}), (SAMPLES[11], set()), (SAMPLES[12], {"mit"}), (SAMPLES[13], {"cc-by-nc"}),
    (SAMPLES[14], {"bsd"}), (SAMPLES[15], {"unlicense"}), (SAMPLES[16], {"cc-by-sa-3.0"}), ("The mit of the general public", set())])
def test_labels(scanner, text, labels):
    assert {d[3] for d in scanner.detect(text.encode())[1]} == labels


def test_gate_and_suppression_lose_nothing(scanner):
    rnd = random.Random(4)
    words = [w for s in SAMPLES for w in s.split()] + ["the", "license", "version", "2", "public", "é", "under", "terms", "of"]
    for _ in range(150):
        text = " ".join(rnd.choice((rnd.choice(SAMPLES), rnd.choice(words))) for _ in range(rnd.randint(1, 12)))
        n, kept = scanner.detect(text.encode())
        assert (n, kept) == (len(plain.alnum_words(text)), ungated(text)), text


def test_keywords_are_never_optional():
    assert L.keywords("gnu (?:old )?licen[sc]e (?:a|b) v?2(?: 0)?") == (
        frozenset({b"gnu"}), frozenset({b"license", b"licence"}), frozenset({b"a", b"b"}))
    for r in L._rules():
        assert " ?" not in r.pattern and " *" not in r.pattern
        assert "|" not in re.sub(r"\([^()]*(?:\([^()]*\)[^()]*)*\)", "", r.pattern), r      # no alternatives at the top level


def test_operator(spark):
    long = "word " * 400_000 + "under the MIT license " + "x " * 10
    rows = [(1, SAMPLES[0], "s"), (2, None, "s"), (3, "", "s"), (None, SAMPLES[1], "s"), (1, SAMPLES[0], "s"), (4, long, "s"), (5, "É under\nthe-MIT\x7flicense", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = L.labelled(L.scan_licenses(df)).collect()
    want = []
    for i, text, _ in rows:
        n, base = base_places(text)
        want.append((i, n, len(base), min((s for s, _ in base), default=None), max((s for s, _ in base), default=None), ",".join(sorted({x for _, x in base}))))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    by = {r.id: r for r in got}
    assert by[4].first_word == 400_000 and by[4].labels == "mit" and by[2].score == 0.0 and by[2].labels == "" and by[1].score == 1.0
    assert L.scan_licenses(df.limit(0)).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = L.op11_license_scan(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        n, base = base_places(texts[r.doc_id])
        kept = ungated(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(base), ",".join(sorted({x for _, x in base})))
        assert (r.first_word, r.last_word) == ((min(s for s, _ in base), max(s for s, _ in base)) if base else (None, None))
        assert r.labels == ",".join(sorted({d[3] for d in kept})) and r.score == max((L.SURE[d[2]] for d in kept), default=0.0)
