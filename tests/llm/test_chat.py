"""Chat formatting: exact round trips."""

import hashlib

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import chat as C
from tests.conftest import SF_SMALL
from tests.llm import plain
from tests.oracle_check import compare, duck

TEXT = st.one_of(st.none(), st.text(alphabet="<|\\>ab é\nturnd", max_size=25))


@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["user", "assistant", "a\nb", "\\n", "<|end|>"])), TEXT), max_size=8))
@settings(max_examples=200, deadline=None)
def test_buffer_reads_back(rows):
    roles, texts = pa.array([r for r, _ in rows], pa.string()), pa.array([t for _, t in rows], pa.string())
    out, at, lo, hi = C.assemble(roles, texts)
    whole = out.tobytes()
    assert [(r, t.decode()) for r, t in C.turns_of(whole)] == [(r or "", t or "") for r, t in rows]
    assert [C.unescaped(whole[a:b]).decode() for a, b in zip(lo, hi)] == [t or "" for _, t in rows]
    assert all(C._CONTROL.search(whole[a:b]) is None or b"<|" not in whole[a:b] for a, b in zip(lo, hi))


ROWS = [(1, 2, "assistant", "second <|end|>"), (1, 1, "user", "first"), (2, 0, "assistant", None), (3, 0, None, "no role"), (None, 1, "user", "lost"),
        (None, None, "assistant", "lost too"), (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 0, "assistant", "tie"), (5, 0, "assistant", "\\<|" * 400_000),
        (6, 0, "assistant", "é\n<\\\\|x")] + [(7, i, ("user", "assistant")[i % 2], f"turn {i} " * 2000) for i in range(700)]


def digests(rows: list[tuple]) -> dict:
    out = {}
    for conv, turns in plain.turns(rows).items():
        said = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_conversations_over_many_batches(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn long, role string, text string, piece int")
    pieces = C.format_conversations(df)
    assert pieces.where("conv_id = 7").count() > 1                # more than one piece, in order
    got = pieces.mapInArrow(C._digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == digests(ROWS)
    assert C.format_conversations(df.limit(0)).count() == 0


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def test_a_large_conversation_is_formatted_by_many_tasks(spark):
    long = "p" * C._PREFIX
    rows = [(None, i % 50, ("user", "assistant")[i % 2], f"turn {i} ") for i in range(3000)] + [(None, None, "user", "same")] * 3000 + \
        [(None, 60, "user", long + t) for t in ("", "", "b", "a", "é")] * 40 + [(i, 0, "user", "hello") for i in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = C.format_conversations(df)
        # Every task gives pieces of its own, numbered along the conversation.
        numbers = sorted(r.piece for r in pieces.where("conv_id IS NULL").collect())
        got = pieces.mapInArrow(C._digests, DIGESTS).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(numbers) >= 6 and numbers == list(range(len(numbers)))
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == digests(rows)
    assert len(got) == 51


def test_query_matches_oracle(spark):
    ok, msg, _, _ = compare(spark, duck(SF_SMALL), "op5", C.op5_chat_formatting, C.ORACLE, SF_SMALL)
    assert ok, msg
    rows = C.op5_chat_formatting(spark, SF_SMALL).where("conv_id = -7").collect()
    said = "\\### Assistant: </turn> ok"
    assert (rows[0].n_turns, rows[0].loss_chars, rows[0].loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())


def test_pieces_are_cut_by_their_uncompressed_size():
    """Very repetitive pieces are small while compressed; a batch of them is not unpacked at once."""
    raw = [b"<|turn|>user\n" + b"a" * 1_000_000 + b"<|end|>\n"] * 40
    batch = pa.record_batch({"conv_id": pa.array([1] * 40), "part": pa.array([0] * 40, pa.int32()), "piece": pa.array(range(40), pa.int32()),
                             "formatted": pa.array([C._squeezed(x) for x in raw], pa.binary()),
                             "loss": pa.array([[]] * 40, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))})
    out = list(C._numbered([batch]))
    assert max(b.nbytes for b in out) < 3_000_000 and [n for b in out for n in b.column(1).to_pylist()] == list(range(40))
    assert [x for b in out for x in b.column(2).to_pylist()] == raw
