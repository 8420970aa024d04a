"""Repairs against a plain program over whole conversations, and all edits of tiny ones."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tessera.llm import repair as R
from tests.conftest import SF_SMALL

GOOD = re.compile(r"(s?(ua)+)?")
BLANKS = " \t\n\x0b\x0c\r"


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(conv, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


def faults(rows):
    """Fault of each (role, text)."""
    seen, out = set(), []
    for r in rows:
        body = r[1].strip(BLANKS)
        out.append("blank" if not body else "duplicate" if r in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add(r)
    return out


def cheapest(rows):
    """(cost, audit, turns) by the least (cost, audit) of every rest, from the end."""
    kinds = faults(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    due = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    best = {(len(rows), "", 0): (0, "", ()), (len(rows), "a", 0): (0, "", ())}

    def better(key, value):
        if key not in best or value[:2] < best[key][:2]:
            best[key] = value

    for i in range(len(rows), -1, -1):
        now = {}
        for st in due:
            ways = []
            if i == len(rows):
                if st in ("", "a"):
                    ways.append((0, "", ()))
            else:
                role, text = rows[i]
                ways.append((2 + best[i + 1, st][0], "D" + best[i + 1, st][1], best[i + 1, st][2]))
                if kinds[i] not in ("blank", "duplicate"):
                    stay = 5 if kinds[i] == "truncated" else 0
                    if (st, role[:1]) in step:
                        b = best[i + 1, step[st, role[:1]]]
                        ways.append((stay + b[0], "K" + b[1], ((role, text), *b[2])))
                    b = best[i + 1, due[st][0]]
                    ways.append((stay + 1 + b[0], "R" + b[1], ((due[st], text), *b[2])))
            now[st] = ways
        for _ in range(4):                                   # insertions before row i
            for st in due:
                after = [w for w in now[due[st][0]]]
                more = [(5 + c, "I" + a, ((due[st], ""), *t)) for c, a, t in after if not a.startswith("III")]
                now[st] = [min(now[st] + more, key=lambda w: w[:2])] if now[st] + more else []
        best.update({(i, st): now[st][0] for st in due})
    return best[0, ""]


def plain_repairs(rows, convs):
    by = defaultdict(list)
    first = lambda v: (v is not None, v if v is not None else 0)
    for r in sorted(rows, key=lambda r: (first(r[1]), r[2], r[3])):
        by[r[0]].append(r)
    out = []
    for conv in convs:
        mine = by[conv]
        said = [r[2:] for r in mine]
        turns = {r[1] for r in mine if r[1] is not None}
        kinds = faults(said)
        initials = [r[0][:1] for r in said]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = cheapest(said)
        assert GOOD.fullmatch("".join(r[0] for r, _ in kept))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, digest))
    return out


def program(rows):
    """(cost, audit) by the operator's program on one piece."""
    kinds = faults(rows)
    p = R.Program(R.Costs())
    symbols = [R._GONE if k in ("blank", "duplicate") else {"s": 0, "u": 1, "a": 2}.get(r[0][:1], 3) + 4 * (k == "truncated") for r, k in zip(rows, kinds)]
    runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
    if not runs:
        return p.end[0], p.tail(0)
    b, lengths = bytes(s for s, _ in runs), tuple(k for _, k in runs)
    letters, end = p.unroll(b, lengths, p.end)[0]
    return R._apply(p.piece(b, lengths), p.end)[0], letters + p.tail(end)


def some_rows(rnd, n):
    return [(rnd.choice(["user", "assistant", "system", "u", "", " ", "tool", "user", "assistant"]), rnd.choice(["Yes.", "no", "", " \n", "Why? ", f"text {rnd.random()}."])) for _ in range(n)]


def every_edit(rows):
    """Least (cost, audit) over all edit strings with at most two insertions in a place."""
    kinds, best = faults(rows), None
    options = [[("D", 2)] if k in ("blank", "duplicate") else [("D", 2), ("K", 5 * (k == "truncated")), ("R", 1 + 5 * (k == "truncated"))] for k in kinds]
    for edits in itertools.product(*options):
        for more in itertools.product(range(3), repeat=len(rows) + 1):
            letters = "I" * more[0] + "".join(e[0] + "I" * m for e, m in zip(edits, more[1:]))
            cost = sum(e[1] for e in edits) + 5 * sum(more)
            if best is not None and (cost, letters) >= best:
                continue
            slots, at = [], 0
            for x in letters:
                if x == "K":
                    slots.append(rows[at][0][:1] or "-")
                elif x in "RI":
                    slots.append("ua")
                at += x != "I"
            if any(GOOD.fullmatch("".join(way)) for way in itertools.product(*slots)):
                best = (cost, letters)
    return best


def test_program_is_the_least_of_all_edits():
    rnd = random.Random(7)
    for _ in range(60):
        rows = some_rows(rnd, rnd.randint(0, 3))
        assert program(rows) == every_edit(rows), rows


def test_program_equals_the_plain_one():
    rnd = random.Random(8)
    for _ in range(400):
        rows = some_rows(rnd, rnd.randint(0, 25))
        assert program(rows) == cheapest(rows)[:2], rows


def test_powers_equal_single_steps():
    p = R.Program(R.Costs(rerole=2, delete=3, insert=4, truncated=1))
    for s in range(R._GONE + 1):
        m = None
        for k in range(1, 40):
            m = p.run(s, 1) if m is None else R._times(m, p.run(s, 1))
            assert p.run(s, k) == m


def test_pieces_join_up():
    rnd = random.Random(9)
    p = R.Program(R.Costs())
    for _ in range(100):
        symbols = [rnd.randrange(9) for _ in range(30)]
        whole = p.unroll(bytes(symbols), [1] * 30, p.end)[0]
        cut = rnd.randint(1, 29)
        after = R._apply(p.piece(bytes(symbols[cut:]), (1,) * (30 - cut)), p.end)
        first, state = p.unroll(bytes(symbols[:cut]), [1] * cut, after)[0]
        assert first + p.unroll(bytes(symbols[cut:]), [1] * (30 - cut), p.end)[state][0] == whole[0]


def made(seed=3):
    rnd = random.Random(seed)
    rows = [(c, t, *some_rows(rnd, 1)[0]) for c in range(40) for t in rnd.sample(range(12), rnd.randint(1, 9))]
    rows += [(None, t, "user", "x.") for t in range(5)] + [(7, None, "system", "Be kind."), (7, None, None, None), (8, 3, None, "a."), (8, 3, None, "a.")]
    rows += [(1000, t // 3, rnd.choice(["user", "assistant"]), rnd.choice(["Same.", f"Text {t}.", "cut"])) for t in range(6000)]         # a hot conversation
    return rows + [(2000, None, "user", "only null turns."), (2001, 1, "user", "long " * 300_000 + ".")]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def test_operator(spark, monkeypatch):
    rows = made()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, letters string")
    hurt_df = R.damage(df)
    convs = sorted({r[0] for r in rows}, key=lambda c: (c is not None, c or 0))
    got = result(R.repair_digests(R.repair_conversations(hurt_df, all_conversations=df.select("conv_id"))))
    assert got == plain_repairs(hurt(rows), convs)


def test_small_pieces_and_empty_table(spark):
    rows = [r for r in made(5) if r[0] != 2001]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    convs = sorted({r[0] for r in rows}, key=lambda c: (c is not None, c or 0))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)      # a piece is at most a batch
    try:
        got = result(R.repair_digests(R.repair_conversations(R.damage(df), all_conversations=df.select("conv_id"))))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain_repairs(hurt(rows), convs)
    assert R.repair_digests(R.repair_conversations(df.limit(0))).count() == 0


def test_conversation_without_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 1, "user", "gone.")], "conv_id long, turn long, role string, text string")
    got = result(R.repair_digests(R.repair_conversations(R.damage(df), all_conversations=df.select("conv_id"))))
    assert got == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    convs = sorted({r[0] for r in rows})
    assert result(R.op12_conversation_repair(spark, SF_SMALL)) == plain_repairs(hurt(rows), convs)
