r"""License scans with ordered signature rules.

A text is folded to its words (A-Z lower-cased, `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`), one space
between, so a rule sees `https://opensource.org/licenses/MIT` as `https opensource org
licenses mit` and line breaks, quotes and comment signs do not matter.  Rules are regular
expressions over that text; a match begins and ends at a word's edge.

Gate.  A rule's whole words outside its optional parts are its keywords.  A rule runs on a
document only if every keyword occurs there; the rules to look at come from an index by each
rule's longest keyword, so an ordinary text is split into words once and no rule runs.

Order.  Rules stand in tiers: `tag`, `text`, `notice`, `url`, `name`, `family`.  A detection
goes if its interval of words lies inside one that stays of an earlier tier, or of the same
tier and longer, or equal and from an earlier rule.  Intervals that only overlap both stay.
Places of the base phrases are always kept and hide nothing.

Every document is worked on by itself, so rows are neither shuffled nor gathered.

Defined cases.  Null and empty texts have no words, no spans, empty labels and score 0.
Texts of any length are scanned whole (words are split one megabyte at a time).  Repeated
rows are scanned each by itself.  An empty table gives no rows.  Columns other than those
named are not read, so a column called `spans` or `labels` does no harm.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
_FOLD = bytes.maketrans(bytes(b for b in _SEPARATORS if b not in _UPPER) + _UPPER,
                        b" " * (len(_SEPARATORS) - len(_UPPER)) + _UPPER.lower())
_PIECE = 1 << 20

TIERS = ("tag", "text", "notice", "url", "name", "family")
#: How sure a tier's detections are.
SURE = {"base": 1.0, "tag": 1.0, "text": 1.0, "notice": 0.95, "url": 0.9, "name": 0.8, "family": 0.5}

# The base phrases and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: (label, versions, names, pages): names and pages are patterns over words; a version follows the name.
LICENSES = (
    ("mit", (), ("mit license", "mit licence", "expat license", "mit x11 license"), ("opensource org licenses? mit", "mit license org")),
    ("mit-0", (), ("mit no attribution license", "mit no attribution"), ()),
    ("apache", ("1.0", "1.1", "2.0"), ("apache (?:software )?licen[sc]e", "asl"), ("apache org licenses license",)),
    ("bsd-2-clause", (), ("(?:simplified|freebsd) bsd license", "(?:2|two) clause bsd license", "bsd (?:2|two) clause license"), ("opensource org licenses? bsd 2 clause",)),
    ("bsd-3-clause", (), ("(?:new|revised|modified) bsd license", "(?:3|three) clause bsd license", "bsd (?:3|three) clause license"), ("opensource org licenses? bsd 3 clause",)),
    ("bsd-4-clause", (), ("original bsd license", "(?:4|four) clause bsd license", "bsd (?:4|four) clause license"), ()),
    ("0bsd", (), ("zero clause bsd license", "bsd zero clause license"), ("opensource org licenses? 0bsd",)),
    ("gpl", ("1.0", "2.0", "3.0"), ("gnu general public licen[sc]e", "gnu gpl", "gpl"), ("gnu org licenses (?:old licenses )?gpl",)),
    ("lgpl", ("2.0", "2.1", "3.0"), ("gnu (?:lesser|library) general public licen[sc]e", "gnu lgpl", "lgpl"), ("gnu org licenses (?:old licenses )?lgpl",)),
    ("agpl", ("1.0", "3.0"), ("(?:gnu )?affero general public licen[sc]e", "gnu agpl", "agpl"), ("gnu org licenses agpl",)),
    ("gfdl", ("1.1", "1.2", "1.3"), ("gnu free documentation licen[sc]e", "gnu fdl", "gfdl"), ("gnu org licenses fdl",)),
    ("mpl", ("1.0", "1.1", "2.0"), ("mozilla public licen[sc]e", "mpl"), ("mozilla org mpl", "mozilla org en us mpl")),
    ("epl", ("1.0", "2.0"), ("eclipse public licen[sc]e", "epl"), ("eclipse org legal epl",)),
    ("edl", ("1.0",), ("eclipse distribution licen[sc]e",), ("eclipse org org documents edl",)),
    ("cddl", ("1.0", "1.1"), ("common development and distribution licen[sc]e", "cddl"), ("opensource org licenses? cddl",)),
    ("cpl", ("1.0",), ("common public licen[sc]e",), ("opensource org licenses? cpl",)),
    ("cpal", ("1.0",), ("common public attribution licen[sc]e",), ("opensource org licenses? cpal",)),
    ("ipl", ("1.0",), ("ibm public licen[sc]e",), ("opensource org licenses? ibmpl",)),
    ("eupl", ("1.0", "1.1", "1.2"), ("european union public licen[sc]e", "eupl"), ("joinup ec europa eu eupl",)),
    ("osl", ("1.0", "2.0", "2.1", "3.0"), ("open software licen[sc]e",), ("opensource org licenses? osl",)),
    ("afl", ("1.1", "1.2", "2.0", "2.1", "3.0"), ("academic free licen[sc]e",), ("opensource org licenses? afl",)),
    ("artistic", ("1.0", "2.0"), ("(?:perl )?artistic licen[sc]e",), ("opensource org licenses? artistic license", "perlfoundation org artistic license")),
    ("apsl", ("1.0", "1.1", "1.2", "2.0"), ("apple public source licen[sc]e",), ("opensource apple com apsl",)),
    ("bsl", ("1.0",), ("boost software licen[sc]e",), ("boost org license",)),
    ("busl", ("1.1",), ("business source licen[sc]e",), ("mariadb com bsl",)),
    ("sspl", ("1.0",), ("server side public licen[sc]e", "sspl"), ("mongodb com licensing server side public license",)),
    ("elastic", ("1.0", "2.0"), ("elastic licen[sc]e",), ("elastic co licensing elastic license",)),
    ("ofl", ("1.0", "1.1"), ("sil open font licen[sc]e",), ("scripts sil org ofl", "openfontlicense org")),
    ("odbl", ("1.0",), ("open (?:data commons )?database licen[sc]e", "odbl"), ("opendatacommons org licenses odbl",)),
    ("odc-by", ("1.0",), ("open data commons attribution licen[sc]e", "odc by"), ("opendatacommons org licenses by",)),
    ("pddl", ("1.0",), ("public domain dedication and licen[sc]e",), ("opendatacommons org licenses pddl",)),
    ("cdla-permissive", ("1.0", "2.0"), ("community data license agreement permissive",), ("cdla dev permissive",)),
    ("cdla-sharing", ("1.0",), ("community data license agreement sharing",), ("cdla dev sharing",)),
    ("cc0", ("1.0",), ("cc0", "creative commons zero", "cc zero"), ("creativecommons org publicdomain zero",)),
    ("ogl-uk", ("1.0", "2.0", "3.0"), ("open government licen[sc]e",), ("nationalarchives gov uk doc open government licence",)),
    ("etalab", ("1.0", "2.0"), ("licence ouverte",), ("etalab gouv fr licence ouverte",)),
    ("dl-de-by", ("1.0", "2.0"), ("datenlizenz deutschland namensnennung",), ("govdata de dl de by",)),
    ("cecill", ("1.0", "1.1", "2.0", "2.1"), ("(?:contrat de )?licence (?:de logiciel libre )?cecill", "cecill"), ("cecill info licences licence cecill",)),
    ("python", ("2.0",), ("python software foundation licen[sc]e", "psf license"), ("docs python org license",)),
    ("php", ("3.0", "3.01"), ("php licen[sc]e",), ("php net license",)),
    ("ruby", (), ("ruby license",), ("ruby lang org en about license",)),
    ("zlib", (), ("zlib license", "zlib libpng license"), ("zlib net zlib license", "opensource org licenses? zlib")),
    ("libpng", (), ("libpng license",), ()),
    ("isc", (), ("isc license", "internet systems consortium license"), ("opensource org licenses? isc",)),
    ("unlicense", (), ("the unlicense", "unlicense license"), ("unlicense org",)),
    ("wtfpl", (), ("do what the fuck you want to public license", "wtfpl"), ("wtfpl net",)),
    ("zpl", ("1.1", "2.0", "2.1"), ("zope public licen[sc]e",), ("zope org resources zpl",)),
    ("ncsa", (), ("university of illinois ncsa open source license",), ("opensource org licenses? ncsa",)),
    ("openssl", (), ("openssl license",), ("openssl org source license",)),
    ("postgresql", (), ("postgresql license",), ("postgresql org about licence", "opensource org licenses? postgresql")),
    ("upl", ("1.0",), ("universal permissive licen[sc]e",), ("opensource org licenses? upl",)),
    ("ms-pl", (), ("microsoft public license",), ("opensource org licenses? ms pl",)),
    ("ms-rl", (), ("microsoft reciprocal license",), ("opensource org licenses? ms rl",)),
    ("ecl", ("1.0", "2.0"), ("educational community licen[sc]e",), ("opensource org licenses? ecl",)),
    ("mulan-psl", ("1.0", "2.0"), ("mulan permissive software licen[sc]e", "mulan psl"), ("license coscl org cn mulanpsl",)),
    ("bigscience-openrail-m", (), ("bigscience open rail m license", "bigscience rail license"), ()),
    ("openrail", (), ("openrail license", "open rail m license", "open responsible ai license"), ("licenses ai",)),
    ("llama2", (), ("llama 2 community license",), ()),
    ("llama3", (), ("(?:meta )?llama 3 community license",), ()),
    ("gemma", (), ("gemma terms of use",), ("ai google dev gemma terms",)),
)

#: (label, page path, long name); versions 1.0 to 4.0.
COMMONS = (
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution (?:share alike|sharealike)"),
    ("cc-by-nd", "by nd", "attribution (?:no derivatives|noderivatives|noderivs)"),
    ("cc-by-nc", "by nc", "attribution (?:non commercial|noncommercial)"),
    ("cc-by-nc-sa", "by nc sa", "attribution (?:non commercial|noncommercial) (?:share alike|sharealike)"),
    ("cc-by-nc-nd", "by nc nd", "attribution (?:non commercial|noncommercial) (?:no derivatives|noderivatives|noderivs)"),
)

#: Passages of the licenses themselves, and of the headers they ask for.
TEXTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "you may not use this (?:file|work) except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name of (?:[^ ]+ ){1,12}nor the names of (?:its|the|any) contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event (?:will|shall) the authors be held liable"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you just do what the fuck you want to"),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation (?:either )?version 2"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation (?:either )?version 3"),
    ("lgpl-2.1", "under the terms of the gnu lesser general public license as published by the free software foundation (?:either )?version 2 1"),
    ("lgpl-3.0", "under the terms of the gnu lesser general public license as published by the free software foundation (?:either )?version 3"),
    ("lgpl-2.0", "under the terms of the gnu library general public license as published by the free software foundation (?:either )?version 2"),
    ("agpl-3.0", "under the terms of the gnu affero general public license as published by the free software foundation (?:either )?version 3"),
    ("gpl-3.0", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3.0", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", "under the terms of the eclipse public license v1 0 which accompanies this distribution"),
    ("epl-2.0", "under the terms of the eclipse public license 2 0 which is available at"),
    ("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1"),
    ("artistic-2.0", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed the artistic license"),
    ("python-2.0", "this license agreement is between the python software foundation"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("upl-1.0", "subject to the following conditions the above copyright notice and either this complete permission notice or at a minimum a reference to the upl must be included"),
    ("sspl-1.0", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("odbl-1.0", "made available under the open database license"),
    ("ogl-uk-3.0", "contains public sector information licensed under the open government licence v3 0"),
    ("public-domain", "(?:this work|this file|this software|this code) (?:is|has been) (?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("non-commercial", "for (?:non commercial|noncommercial) (?:use|purposes) only"),
    ("no-redistribution", "may not be (?:copied|reproduced|redistributed)(?: [^ ]+){0,4} without (?:prior |express )?(?:written )?permission"),
)

#: Names without a version.
FAMILIES = (
    ("gpl", "gnu general public licen[sc]e"), ("gpl", "gnu gpl"), ("lgpl", "gnu (?:lesser|library) general public licen[sc]e"), ("lgpl", "gnu lgpl"),
    ("agpl", "(?:gnu )?affero general public licen[sc]e"), ("gfdl", "gnu free documentation licen[sc]e"), ("apache", "apache (?:software )?licen[sc]e"),
    ("mpl", "mozilla public licen[sc]e"), ("epl", "eclipse public licen[sc]e"), ("cddl", "common development and distribution licen[sc]e"),
    ("bsd", "bsd (?:style )?licen[sc]e"), ("artistic", "artistic licen[sc]e"), ("bsl", "boost software licen[sc]e"), ("ofl", "open font licen[sc]e"),
    ("cc0", "creative commons zero"), ("cc", "creative commons licen[sc]e"), ("eupl", "european union public licen[sc]e"), ("odbl", "open database licen[sc]e"),
    ("cecill", "licence cecill"), ("ogl-uk", "open government licen[sc]e"),
)

_NOTICE = "(?:licen[sc]ed|released|distributed|available|published|provided|covered|shared) under (?:the )?(?:terms of )?(?:the |an? )?"


@dataclass(frozen=True)
class Rule:
    label: str
    tier: str
    pattern: str


def _version(number: str) -> str:
    major, minor = number.split(".")
    return f"(?:version |v |ver )?v?{major}" + ("(?: 0)?" if minor == "0" else f" {minor}")


def _rules() -> tuple[Rule, ...]:
    """All rules, tier by tier, in the order of the tables."""
    named: list[tuple[str, str]] = []                 # (label, pattern of the name with its version)
    pages: list[tuple[str, str]] = []
    for label, versions, names, places in LICENSES:
        for v in versions:
            named += [(f"{label}-{v}", f"{name} {_version(v)}") for name in names]
            named += [(f"{label}-{v}", f"{name}v{v[0]}" + ("(?: 0)?" if v.endswith(".0") else v[1:].replace(".", " "))) for name in names if name.isalpha()]
            pages += [(f"{label}-{v}", f"{p} {_version(v)}") for p in places]
        if not versions:
            named += [(label, name) for name in names]
            pages += [(label, p) for p in places]
    for label, path, long in COMMONS:
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            named += [(f"{label}-{v}", f"cc {path} {_version(v)}"), (f"{label}-{v}", f"creative commons {path} {_version(v)}"),
                      (f"{label}-{v}", f"creative commons {long} {_version(v)}"),
                      (f"{label}-{v}", f"creative commons {long} (?:international |unported |generic )?(?:public )?licen[sc]e {_version(v)}")]
            pages += [(f"{label}-{v}", f"creativecommons org licenses {path} {v.replace('.', ' ')}")]
    labels = dict.fromkeys(label for label, _ in named)
    family = [*FAMILIES, *[(label, f"(?:cc|creative commons) {path}") for label, path, _ in COMMONS],
              *[(label, f"creative commons {long}") for label, _, long in COMMONS]]
    known = {"tag": [(label, f"spdx license identifier (?:[^ ]+ ){{0,1}}{re.sub('[^0-9a-z]+', ' ', label)}(?: only| or later)?") for label in labels],
             "text": TEXTS, "notice": [(label, _NOTICE + name) for label, name in named], "url": pages, "name": named, "family": family}
    return tuple(Rule(label, tier, pattern) for tier in TIERS for label, pattern in known[tier])


def keywords(pattern: str) -> tuple[frozenset[bytes], ...]:
    """Words of which every match holds one of each set: the pattern's top-level words without optional parts."""
    parts, depth, word = [], 0, ""
    for i, c in enumerate(pattern):
        escaped = i and pattern[i - 1] == "\\"
        depth += (c == "(" and not escaped) - (c == ")" and not escaped)
        if c == " " and not depth and "[" not in word[word.rfind("]") + 1:]:
            parts.append(word)
            word = ""
        else:
            word += c
    out = []
    for part in (*parts, word):
        part = re.sub(r"^(?:\(\?:(?:[^()|]* \|)*[^()|]* \)\?)+", "", part)           # optional words before it
        part = re.sub(r"(?:\(\?:(?: [^()|]*\|)* [^()|]*\)\?)+$", "", part)           # and after it
        whole = re.fullmatch(r"\(\?:([0-9a-z|]+)\)", part)
        if whole:
            out.append(frozenset(w.encode() for w in whole[1].split("|")))
        elif re.fullmatch(r"(?:[0-9a-z]|\[[0-9a-z]+\])+", part):
            letters = [x[1:-1] if x[0] == "[" else x for x in re.findall(r"\[[0-9a-z]+\]|[0-9a-z]", part)]
            out.append(frozenset("".join(p).encode() for p in itertools.product(*letters)))
    return tuple(out)


def folded(raw: bytes):
    """The lists of words of a text, piece by piece."""
    text, at = raw.translate(_FOLD), 0
    while at < len(text):
        to = text.find(b" ", at + _PIECE)
        to = len(text) if to < 0 else to
        yield text[at:to].split()
        at = to


class Scanner:
    """Rules compiled once per task; only patterns travel."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        edge = lambda p: re.compile(rb"(?<= )(?:" + p.encode() + rb")(?= )")
        self.base = [(edge(p), frozenset(p.encode().split()), label) for p, label in BASE]
        self.found = [edge(r.pattern) for r in rules]
        self.needs = [keywords(r.pattern) for r in rules]
        if not all(self.needs):
            raise ValueError("a rule needs a word that is not optional")
        self.by_word: dict[bytes, list[int]] = {}
        for i, needs in enumerate(self.needs):
            for w in max(needs, key=lambda s: (min(map(len, s)), sorted(s))):
                self.by_word.setdefault(w, []).append(i)
        self.gate = frozenset(itertools.chain(*(s for n in self.needs for s in n), *(words for _, words, _ in self.base)))

    def detect(self, raw: bytes) -> tuple[int, list[tuple]]:
        """(words, kept detections (first word, word after the last, tier, label) by place)."""
        n, present, pieces = 0, set(), []
        for words in folded(raw):
            n += len(words)
            present |= self.gate.intersection(words)
            pieces.append(b" ".join(words))
        base = [b for b in self.base if b[1] <= present]
        rules = sorted({i for w in present for i in self.by_word.get(w, ()) if all(not s.isdisjoint(present) for s in self.needs[i])})
        if not base and not rules:
            return n, []
        text = b" " + b" ".join(p for p in pieces if p) + b" "
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)

        def places(rule):
            spans = np.array([m.span() for m in rule.finditer(text)], np.int64).reshape(-1, 2)
            return np.searchsorted(spaces, spans[:, 0]) - 1, np.searchsorted(spaces, spans[:, 1])

        out = [(int(s), int(e), "base", label) for rule, _, label in base for s, e in zip(*places(rule))]
        tiers: dict[str, list[tuple]] = {}
        for i in rules:
            tiers.setdefault(self.rules[i].tier, []).extend((int(s), int(e), i) for s, e in zip(*places(self.found[i])))
        out += [(s, e, self.rules[i].tier, self.rules[i].label) for s, e, i in unsuppressed([tiers.get(t, []) for t in TIERS])]
        return n, sorted(out)


def unsuppressed(tiers: list[list[tuple]]) -> list[tuple]:
    """The intervals (start, end, rule) not contained in one kept before: earlier tiers first, then longer, then earlier rules."""
    kept: list[tuple] = []
    for found in tiers:
        if not found:
            continue
        before = np.array(sorted((s, e) for s, e, _ in kept), np.int64).reshape(-1, 2)
        reach = np.maximum.accumulate(before[:, 1]) if len(before) else before[:, 1]
        inside = -1                                    # furthest end in this tier so far; starts ascend, longer ones come first
        new = []
        for s, e, i in sorted(found, key=lambda x: (x[0], -x[1], x[2])):
            k = int(np.searchsorted(before[:, 0], s, "right"))
            if e <= inside or (k and reach[k - 1] >= e):
                continue
            new.append((s, e, i))
            inside = e
        kept += new
    return kept


def _scan(rules: tuple[Rule, ...]):
    def run(batches):
        scanner = Scanner(rules)
        for batch in batches:
            texts, counts, spans = batch.column(1).cast(pa.large_binary()), [], []
            for raw in texts:
                n, kept = scanner.detect(raw.as_py() or b"")
                counts.append(n)
                spans.append([{"label": label, "tier": tier, "first": s, "last": e - 1} for s, e, tier, label in kept])
            kind = pa.list_(pa.struct([("label", pa.string()), ("tier", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))
            yield pa.record_batch({"id": batch.column(0), "n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, kind)})
    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """Per document row: id, n_words, spans (label, tier, first, last: words from 0, the last one included)."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _scan(_rules() if rules is None else rules),
        f"id {kind}, n_words long, spans array<struct<label:string,tier:string,first:long,last:long>>")


def labelled(found: DataFrame) -> DataFrame:
    """Counts, labels and score from the spans."""
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    base = F.filter("spans", lambda s: s["tier"] == "base")
    starts = F.transform(base, lambda s: s["first"])
    sure = F.create_map(*[F.lit(x) for pair in SURE.items() for x in pair])
    return found.select(
        "id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: sure[s["tier"]])), F.lit(0.0)).alias("score"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and signature rules over every whole text."""
    return labelled(scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))).withColumnRenamed("id", "doc_id")
