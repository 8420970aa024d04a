"""Secret scans with one deterministic automaton for all rules.

One byte pass marks the bytes at which some rule could end.  While any match is under way
the automaton is outside its start state, so every match lies inside one stretch of such
bytes; only stretches with a marked byte are looked at again.  There a pass from the end, with
the automaton of a marked rule's reversed words, finds the places at which its matches begin,
and from these its own (anchored) automaton takes leftmost, longest, non-overlapping
matches; what is too short is dropped.  A match under way never runs on far beyond its end,
and no place without a match is tried, so the time is linear in the text.  Counting a least length in the combined automaton multiplies its states,
so only the hex rule, which would mark ordinary words, has one there, and a smaller one.

Texts are scanned whole, many at once: a zero byte stands between documents and takes part
in no rule.  Offsets are counted in code points, the end excluded.

Defined cases.  Null and empty texts have no spans.  Repeated rows are scanned each by
itself.  Rules match ASCII; other characters end a match.  Columns other than those named
are not read.  Spans are ordered by start, then in the order of the rules.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import tokens as T
from tessera.llm.automaton import Automaton, begins, compile_rules, longest, scan

@dataclass(frozen=True)
class Rule:
    kind: str
    whole: str       # what a match is, of any length
    marks: str       # the same with a least length that every match that is kept has
    value: int       # least length of the value at the match's end (0: of the whole match)
    least: int


def _either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


# Fixed values.
_NAME = "(" + _either_case("password|passwd|secret|token|api_?key") + ")"
_GLUE = "[\"']?\\x20*[:=]\\x20*[\"']?"
_VALUE = "[A-Za-z0-9+/_.=-]"
BASE = (
    Rule("assign", f"{_NAME}{_GLUE}{_VALUE}+", f"{_NAME}{_GLUE}{_VALUE}+", 1, 8),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{16,}", 0, 32),
)
#: Formats that issuers publish.
MORE = (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 0),
)


class Scanner:
    """Compiled once on the driver; the arrays travel with the function."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.all: Automaton = compile_rules([r.marks for r in rules], search=True)
        self.one = [compile_rules([r.whole], search=False) for r in rules]
        self.back = [compile_rules([r.whole], search=True, backwards=True) for r in rules]
        # Where a kept match's value begins: the longest match of what stands before it.
        self.head = [compile_rules([_NAME + _GLUE], search=False) if r.value else None for r in rules]

    def spans(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, of a buffer whose documents are parted by zero bytes."""
        states = scan(self.all, data)
        marked = np.flatnonzero(self.all.ends[states])
        if not len(marked):
            return []
        idle = np.flatnonzero(states == 0)
        begin = np.searchsorted(idle, marked)                # stretch between two idle bytes
        out = []
        for b in np.unique(begin):
            lo = int(idle[b - 1]) + 1 if b else 0
            hi = int(idle[b]) if b < len(idle) else len(data)
            piece = data[lo:hi].tobytes()
            rules = int(np.bitwise_or.reduce(self.all.ends[states[lo:hi]]))
            for r, rule in enumerate(self.rules):
                if rules >> r & 1:
                    out += [(lo + s, r, lo + e) for s, e in self._take(piece, r, rule)]
        return sorted(out)

    def _take(self, piece: bytes, r: int, rule: Rule):
        """Leftmost, longest matches that do not overlap, then those that are long enough."""
        free = 0
        for at in begins(self.back[r], piece):
            if at < free:
                continue
            end = longest(self.one[r], piece, at)
            value = longest(self.head[r], piece, at) if rule.value else at
            if end - value >= rule.least:
                yield at, end
            free = end


def _scan(scanner: Scanner, base: int):
    def run(batches):
        for part in T.chunks(batches):
            raw, off = T.column_bytes(part.column(1))
            n = part.num_rows
            data = np.zeros(len(raw) + n, np.uint8)          # a zero byte after every document
            at = off + np.arange(n + 1)
            data[np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(off))] = raw
            counts = np.zeros((n, base), np.int64)
            texts: list[list[str]] = [[] for _ in range(n)]
            only: list[list[str]] = [[] for _ in range(n)]
            points: dict[int, np.ndarray] = {}
            for s, r, e in scanner.spans(data):
                d = int(np.searchsorted(at, s, "right")) - 1
                if d not in points:                          # bytes to code points, for documents with spans
                    points.clear()
                    points[d] = np.concatenate((np.zeros(1, np.int64), np.cumsum((data[at[d]:at[d + 1]] & 0xC0) != 0x80)))
                name = f"{scanner.rules[r].kind}:{points[d][s - at[d]]}:{points[d][e - at[d]]}"
                texts[d].append(name)
                if r < base:
                    only[d].append(name)
                    counts[d, r] += 1
            yield pa.record_batch({"id": part.column(0), **{f"n_{scanner.rules[i].kind}": pa.array(counts[:, i]) for i in range(base)},
                                   "base_sha256": pa.array([hashlib.sha256(",".join(t).encode()).hexdigest() for t in only]),
                                   "spans": pa.array([",".join(t) for t in texts])})
    return run


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = MORE) -> DataFrame:
    """Per document row: id, counts of the base kinds, digest of the base spans, all spans as kind:start:end."""
    scanner = Scanner((*BASE, *rules))
    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"n_{r.kind} long" for r in BASE)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _scan(scanner, len(BASE)), f"id {kind}, {counts}, base_sha256 string, spans string")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added rules over every whole text."""
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
