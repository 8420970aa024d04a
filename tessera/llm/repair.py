r"""Conversation structure repair by a run-length dynamic program.

A conversation's rows become symbols: the role's initial (s, u, a or another) and whether the
row must go (blank or duplicate), ends without a sentence mark (truncated) or is clean.  Edits
(keep, rerole, delete, insert) lead through the four states of `(s?(ua)+)?`, so every symbol
is a 4 x 4 matrix of least costs in the (min, +) algebra.

Equal consecutive symbols are collapsed to runs; a run's matrix is the product of the cached
binary powers of its symbol's matrix, a piece's matrix the product of its runs'.  Going
backwards over the pieces' matrices gives the least cost that is still to come after each
piece.  From there every piece is unrolled by itself: for each state it may begin in, the
smallest letter of an edit that is on a cheapest way, row by row.  A letter determines the
edit (the role that is due follows from the state), so the audit is the ASCII-least one.

Order and size.  Rows are range-partitioned and sorted by (conversation, turn, role, text) and
packed into pieces of about a megabyte, so a conversation that holds a third of all rows is
many tasks' work: packing, finding duplicates, matrices and unrolling run piece by piece.
Only the pieces' matrices, and at the end the repaired turns, go through one task in order,
as a stream, because a digest of a conversation is sequential.  A duplicate is a row that is
not the first of its (conversation, role, text), found by a pre-aggregated minimum of places.

Defined cases.  Null role and null text are one space.  Null turns come first; rows of equal
turn are ordered by role, then text.  Rows without a conversation id are one conversation.
Repeated rows are rows of their own (and duplicates).  A conversation without rows (all of
them dropped) has zeros and nothing repaired.  An empty table gives no rows.  Columns other
than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import tokens as T
from tessera.session import scratch_path

_PREFIX = 256
_BLANKS = " \t\n\x0b\x0c\r"
_FAR = 1 << 60
#: Symbols: 0-3 clean s, u, a, other; 4-7 the same, truncated; 8 to be deleted.
_GONE = 8
#: State after a role's initial: 0 nothing yet, 1 after s, 2 after u, 3 after a.
_NEXT = {(0, 0): 1, (1, 0): 2, (1, 1): 2, (2, 2): 3, (1, 3): 2}
_DUE = (1, 1, 2, 1)                            # initial that is due in a state, apart from s
_ROLES = {1: "user", 2: "assistant"}
_ACCEPTED = (0, 3)


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5                         # added for every truncated row that stays


def _times(a, b):
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _apply(a, v):
    return tuple(min(a[i][k] + v[k] for k in range(4)) for i in range(4))


class Program:
    """Matrices, cached powers and choices for given costs."""

    def __init__(self, costs: Costs):
        if min(costs.insert, costs.delete) < 1:
            raise ValueError("insert and delete must cost something")
        self.costs = costs
        self.after_due = tuple(_NEXT[_DUE[i], i] for i in range(4))
        # Cheapest insertions from state to state.
        one = tuple(tuple(0 if i == j else costs.insert if j == self.after_due[i] else _FAR for j in range(4)) for i in range(4))
        self.inserts = _times(_times(one, one), _times(one, one))
        self.end = _apply(self.inserts, tuple(0 if i in _ACCEPTED else _FAR for i in range(4)))
        self.powers = [[_times(self.inserts, self._row(s))] for s in range(_GONE + 1)]
        self.steps: dict[tuple, tuple] = {}
        self.piece = lru_cache(1 << 14)(self._piece)

    def _edits(self, symbol: int, state: int) -> list[tuple[str, int, int]]:
        """(letter, cost, next state) of the edits that use up a row."""
        out = [("D", self.costs.delete, state)]
        if symbol != _GONE:
            stays = self.costs.truncated if symbol >= 4 else 0
            if (symbol % 4, state) in _NEXT:
                out.append(("K", stays, _NEXT[symbol % 4, state]))
            out.append(("R", stays + self.costs.rerole, self.after_due[state]))
        return out

    def _row(self, symbol: int):
        row = [[_FAR] * 4 for _ in range(4)]
        for i in range(4):
            for _, cost, j in self._edits(symbol, i):
                row[i][j] = min(row[i][j], cost)
        return tuple(map(tuple, row))

    def run(self, symbol: int, length: int):
        """Matrix of a run, by the binary digits of its length."""
        powers, out, bit = self.powers[symbol], None, 0
        while length >> bit:
            if bit == len(powers):
                powers.append(_times(powers[-1], powers[-1]))
            if length >> bit & 1:
                out = powers[bit] if out is None else _times(out, powers[bit])
            bit += 1
        return out

    def _piece(self, symbols: bytes, lengths: tuple[int, ...]):
        out = None
        for s, k in zip(symbols, lengths):
            m = self.run(s, k)
            out = m if out is None else _times(out, m)
        return out

    def step(self, symbol: int, after: tuple) -> tuple:
        """(costs to come before a row, letters and next state for each state), both for costs relative to the least."""
        known = self.steps.get((symbol, after))
        if known is None:
            edits = [self._edits(symbol, i) for i in range(4)]
            before = _apply(self.inserts, tuple(min(c + after[j] for _, c, j in edits[i]) for i in range(4)))
            choices = []
            for i in range(4):
                letters, at = "", i
                while True:
                    ways = {letter: j for letter, c, j in reversed(edits[at]) if c + after[j] == before[at]}
                    if self.costs.insert + before[self.after_due[at]] == before[at]:
                        ways["I"] = self.after_due[at]
                    letter = min(ways)
                    letters, at = letters + letter, ways[letter]
                    if letter != "I":
                        break
                choices.append((letters, at))
            low = min(before)
            known = self.steps[symbol, after] = (tuple(b - low for b in before), tuple(choices))
        return known

    def unroll(self, symbols: bytes, lengths, after) -> list[tuple[str, int]]:
        """For each state at the beginning: the letters of the piece and the state at its end."""
        low, back = min(after), []
        now = tuple(a - low for a in after)
        for s, k in zip(reversed(symbols), reversed(lengths)):
            while k:
                before, choices = self.step(s, now)
                same = k if before == now else 1             # nothing changes any more inside the run
                back += [choices] * same
                now, k = before, k - same
        out = []
        for state in range(4):
            letters = []
            for choices in reversed(back):
                more, state = choices[state]
                letters.append(more)
            out.append(("".join(letters), state))
        return out

    def tail(self, state: int) -> str:
        """Insertions after the last row."""
        out = ""
        while self.end[state]:
            out, state = out + "I", self.after_due[state]
        return out


def apply_letters(letters: str, roles: list[str], texts: list[str], state: int) -> list[tuple[str, str]]:
    """The turns (role, text) that remain of a piece."""
    out, at = [], 0
    for letter in letters:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            initial, turn = "sua".find(roles[at][:1]), (roles[at], texts[at])
        else:
            initial = _DUE[state]
            turn = (_ROLES[initial], "" if letter == "I" else texts[at])
        out.append(turn)
        state = _NEXT[initial, state]
        at += letter != "I"
    return out


# ------------------------------------------------------------------ inside tasks

def _pack(batches):
    """Sorted rows to pieces: contiguous rows of one conversation inside a chunk."""
    part, number = TaskContext.get().partitionId(), 0
    for chunk in T.chunks(batches):
        ids, n = chunk.column(0), chunk.num_rows
        code = ids.dictionary_encode("encode").indices.to_numpy()
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        ends = np.append(first, n)
        turn = chunk.column(1)
        valid = turn.is_valid().to_numpy(zero_copy_only=False)
        value = turn.fill_null(0).to_numpy()
        starts = valid.copy()                                # first row of each turn of a piece
        starts[1:] &= ~valid[:-1] | (value[1:] != value[:-1])
        starts[first] = valid[first]
        lo, hi, turns = [], [], []
        for a, b in zip(ends[:-1], ends[1:]):
            known = value[a:b][valid[a:b]]
            lo.append(int(known[0]) if len(known) else None)
            hi.append(int(known[-1]) if len(known) else None)
            turns.append(int(starts[a:b].sum()))
        cuts = pa.array(ends.astype(np.int32))
        yield pa.record_batch({
            "conv": ids.take(pa.array(first)), "part": pa.array(np.full(len(first), part, np.int32)), "piece": pa.array(number + np.arange(len(first))),
            "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64()), "turns": pa.array(turns, pa.int64()),
            **{name: pa.ListArray.from_arrays(cuts, chunk.column(i)) for name, i in (("flags", 4), ("roles", 2), ("texts", 3))}})
        number += len(first)


_NARROW = "conv {kind}, part int, piece long, lo long, hi long, turns long"


def _summarise(costs: Costs):
    """Pieces with their places of first occurrence to counts, runs and matrix."""
    def run(batches):
        program = Program(costs)
        for batch in batches:
            out = []
            for r in batch.select(["flags", "firsts"]).to_pylist():
                flags = np.array(r["flags"], np.int64)
                initial, blank, cut = flags & 3, (flags & 4) > 0, (flags & 8) > 0
                again = np.ones(len(flags), bool)
                again[r["firsts"] or []] = False
                duplicate = again & ~blank
                cut = cut & ~blank & ~duplicate
                symbol = np.where(blank | duplicate, _GONE, initial + 4 * cut)
                begin = np.flatnonzero(np.concatenate(([True], symbol[1:] != symbol[:-1])))
                symbols = symbol[begin].astype(np.uint8).tobytes()
                lengths = np.diff(np.append(begin, len(symbol))).tolist()
                a, b = initial[:-1], initial[1:]
                legal = ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
                matrix = program.piece(symbols, tuple(lengths))
                out.append({"blank": int(blank.sum()), "duplicate": int(duplicate.sum()), "truncated": int(cut.sum()), "illegal": int((~legal).sum()),
                            "first": int(initial[0]), "last": int(initial[-1]), "symbols": symbols, "lengths": lengths, "matrix": [x for row in matrix for x in row]})
            more = pa.RecordBatch.from_pylist(out, pa.schema([
                *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "first", "last")],
                ("symbols", pa.binary()), ("lengths", pa.list_(pa.int64())), ("matrix", pa.list_(pa.int64()))]))
            keep = ["conv", "part", "piece", "lo", "hi", "turns"]
            yield pa.record_batch([*[batch.column(batch.schema.names.index(c)) for c in keep], *more.columns], names=[*keep, *more.schema.names])
    return run


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _scan(costs: Costs):
    """Pieces of a conversation from the last to the first, then its mark (part -1): costs to come after each, and the sums."""
    def run(batches):
        program = Program(costs)
        new = lambda: {"v": program.end, "lo": None, "hi": None, "turns": 0, "next": None, "next_lo": None, **dict.fromkeys(_COUNTS, 0)}
        now = new()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                row = {"conv": r["conv"], "part": r["part"], "piece": r["piece"]}
                if r["part"] < 0:
                    gaps = now["hi"] - now["lo"] + 1 - now["turns"] if now["turns"] else 0
                    out.append(row | {c: now[c] for c in _COUNTS} | {"gaps": gaps, "cost": now["v"][0]})
                    now = new()
                    continue
                out.append(row | {"symbols": r["symbols"], "lengths": r["lengths"], "after": list(now["v"])})
                m = r["matrix"]
                now["v"] = _apply([m[0:4], m[4:8], m[8:12], m[12:16]], now["v"])
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    now[c] += r[c]
                if now["next"] is not None:
                    now["illegal"] += (r["last"], now["next"]) not in ((0, 1), (1, 2), (2, 1))
                now["next"] = r["first"]
                if r["turns"]:
                    now["turns"] += r["turns"] - (r["hi"] == now["next_lo"])
                    now["lo"], now["next_lo"] = r["lo"], r["lo"]
                    now["hi"] = r["hi"] if now["hi"] is None else now["hi"]
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("conv", batch.schema.field("conv").type), ("part", pa.int32()), ("piece", pa.int64()), *[(c, pa.int64()) for c in _COUNTS],
                ("symbols", pa.binary()), ("lengths", pa.list_(pa.int64())), ("after", pa.list_(pa.int64()))]))
    return run


def _unroll(costs: Costs):
    """Letters and end state of every piece, for each state at its beginning."""
    def run(batches):
        program = Program(costs)
        for batch in batches:
            letters, ends = [], []
            for r in batch.select(["symbols", "lengths", "after"]).to_pylist():
                ways = program.unroll(r["symbols"], r["lengths"], r["after"]) if r["symbols"] is not None else []
                letters.append([w for w, _ in ways])
                ends.append([e for _, e in ways])
            keep = ["conv", "part", "piece", *_COUNTS]
            yield pa.record_batch([*[batch.column(batch.schema.names.index(c)) for c in keep], pa.array(letters, pa.list_(pa.string())),
                                   pa.array(ends, pa.list_(pa.int64()))], names=[*keep, "letters", "ends"])
    return run


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _repair(costs: Costs):
    """In order: a conversation's sums, then letters and texts of each piece -> its sums, then letters and repaired turns."""
    def run(batches):
        program = Program(costs)
        state, conv, ways = 0, None, None

        def said(conv, letters, turns):
            return {"conv": conv, "letters": letters, "turns": [{"role": role, "text": text} for role, text in turns]}

        def tail():
            more = program.tail(state) if conv is not None else ""
            return [said(conv[0], more, apply_letters(more, [], [], state))] if more else []

        for batch in batches:                                # some megabytes of texts
            schema = pa.schema([("conv", batch.schema.field("conv").type), *[(c, pa.int64()) for c in _COUNTS], ("letters", pa.string()), ("turns", _TURNS)])
            out = []
            for r in batch.to_pylist():
                if r["part"] < 0:
                    out += [*tail(), {"conv": r["conv"], **{c: r[c] for c in _COUNTS}}]
                    conv, state = (r["conv"],), 0
                elif r["kind"] == 0:
                    ways = list(zip(r["letters"], r["ends"]))
                else:
                    letters, end = ways[state]
                    out.append(said(r["conv"], letters, apply_letters(letters, r["roles"], r["texts"], state)))
                    state = end
            yield pa.RecordBatch.from_pylist(out, schema)
        if tail():
            yield pa.RecordBatch.from_pylist(tail(), schema)
    return run


def _digests(batches):
    """A row per conversation from its sums and repaired pieces, which come in order."""
    now = None

    def row():
        return {"conv": now["conv"], **{c: now[c] for c in _COUNTS}, "audit": "".join(now["audit"]), "repaired_sha256": now["sha"].hexdigest()}

    for batch in batches:
        schema = pa.schema([("conv", batch.schema.field("conv").type), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
        done = []
        for r in batch.to_pylist():
            if r["letters"] is None:
                done += [row()] if now else []
                now = {**r, "audit": [], "sha": hashlib.sha256(), "some": False}
                continue
            now["audit"].append(r["letters"])
            for t in r["turns"]:
                now["sha"].update(("\n" if now["some"] else "").encode() + f"{t['role']}:{t['text']}".encode())
                now["some"] = True
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if now:
        yield pa.RecordBatch.from_pylist([row()], schema)


# ------------------------------------------------------------------ jobs

def symbols_of(rows: DataFrame) -> DataFrame:
    """Adds `flags`: the role's initial (0-3), 4 for blank and 8 for truncated texts."""
    initial = F.substring("role", 1, 1)
    trimmed = F.rtrim(F.col("text"), F.lit(_BLANKS))
    flags = (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
             + F.when(trimmed == "", 4).otherwise(0) + F.when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 0).otherwise(8))
    return rows.withColumn("flags", flags.cast("int"))


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         costs: Costs = Costs(), all_conversations: DataFrame | None = None) -> DataFrame:
    """(conv, sums, letters, turns): per conversation a row with its sums, then its repaired turns piece by piece, in order.

    `all_conversations`: one column of conversation ids, all of which get a row of sums; by default those of `rows`.
    """
    spark = rows.sparkSession
    kind = rows.schema[conv].dataType.simpleString()
    base = scratch_path(spark, "repair")
    view = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
                       F.coalesce(text, F.lit(" ")).alias("text"))
    # Rows equal in everything are dealt out; those longer than the bounds' beginning of a text stay together, after it.
    spread = F.when(F.length("text") > _PREFIX, F.lit((1 << 31) - 1)).otherwise(F.spark_partition_id())
    ordered = symbols_of(view).withColumn("spread", spread).repartitionByRange("conv", "turn", "role", F.substring("text", 1, _PREFIX), "spread") \
        .sortWithinPartitions("conv", "turn", "role", "text").drop("spread")
    narrow = _NARROW.format(kind=kind)
    ordered.mapInArrow(_pack, f"{narrow}, flags array<int>, roles array<string>, texts array<string>").write.parquet(base)
    pieces = spark.read.parquet(base)
    said = pieces.select("conv", "part", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "t"))
    digest = F.sha2(F.concat(F.length("t.roles").cast("string"), F.lit(":"), F.col("t.roles"), F.col("t.texts")), 256)
    firsts = said.select("conv", F.unhex(digest).alias("d"), F.struct("part", "piece", "at").alias("place")).groupBy("conv", "d").agg(F.min("place").alias("p")) \
        .groupBy("p.part", "p.piece").agg(F.collect_list("p.at").alias("firsts"))               # at most the rows of a piece
    counted = pieces.drop("roles", "texts").join(firsts, ["part", "piece"], "left").select("conv", "part", "piece", "lo", "hi", "turns", "flags", "firsts") \
        .mapInArrow(_summarise(costs), narrow + ", " + ", ".join(f"{c} long" for c in ("blank", "duplicate", "truncated", "illegal", "first", "last"))
                    + ", symbols binary, lengths array<long>, matrix array<long>")
    named = rows.select(conv) if all_conversations is None else all_conversations
    marks = named.toDF("conv").distinct().select("conv", F.lit(-1).alias("part"), F.lit(-1).cast("long").alias("piece"))
    sums = ", ".join(f"{c} long" for c in _COUNTS)
    scanned = counted.unionByName(marks, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", F.desc("part"), F.desc("piece")) \
        .mapInArrow(_scan(costs), f"conv {kind}, part int, piece long, {sums}, symbols binary, lengths array<long>, after array<long>")
    ways = scanned.repartition("part", "piece", "conv").mapInArrow(_unroll(costs), f"conv {kind}, part int, piece long, {sums}, letters array<string>, ends array<long>")
    both = ways.withColumn("kind", F.lit(0)).unionByName(pieces.select("conv", "part", "piece", "roles", "texts", F.lit(1).alias("kind")), allowMissingColumns=True)
    return both.repartition("conv").sortWithinPartitions("conv", "part", "piece", "kind") \
        .mapInArrow(_repair(costs), f"conv {kind}, {sums}, letters string, turns array<struct<role:string,text:string>>")


def repair_digests(repaired: DataFrame) -> DataFrame:
    """A row per conversation: sums, audit and the digest of its repaired turns."""
    kind = repaired.schema["conv"].dataType.simpleString()
    sums = ", ".join(f"{c} long" for c in _COUNTS)
    return repaired.mapInArrow(_digests, f"conv {kind}, {sums}, audit string, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """Drops, empties, cuts, repeats and reroles rows by the checksum of `conv_id:turn`."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    kind = F.crc32(key) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text)
    hurt = rows.withColumn("kind", kind).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
    return hurt.drop("col")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    repaired = repair_conversations(damage(rows), all_conversations=rows.select("conv_id"))
    return repair_digests(repaired).withColumnRenamed("conv", "conv_id").select(
        "conv_id", *_COUNTS, "audit", "repaired_sha256")
