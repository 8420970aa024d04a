r"""Chat formatting by columnar byte assembly, with a loss mask.

A turn becomes `<|turn|>ROLE\nTEXT<|end|>\n`.  Inside texts every `<`, backslashes, `|` in a
row gets one backslash more, so a control string never stands in a text and taking one
backslash away gives the text back; roles escape backslashes and line ends as well.

The turns of a batch are written into one preallocated buffer: lengths of headers, contents
and footers, their running sums as offsets, then indexed copies of all headers, contents and
footers at once.  The buffer is the Arrow column: rows are slices of it, one per conversation
and batch.  A conversation that goes on in the next batch is more than one piece, so neither
a long one nor one with very many turns is held in memory.  The loss mask lists the byte
ranges of a piece that hold assistant texts, without header and footer.

All rows are range-partitioned and sorted (by conversation, turn, role and text), so a
conversation with many rows is sorted and formatted by many tasks.  Only its finished pieces,
compressed on the way, come together, in order, to be numbered and read back as a stream.

Defined cases.  Null text and null role are empty.  Rows without a conversation id form one
conversation.  A null turn comes first.  Repeated rows are turns of their own.  An empty table
gives no rows.  Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import tokens as T
from tessera.llm.backoff import _squeezed, _unsqueezed

TURN, END = b"<|turn|>", b"<|end|>\n"
ASSISTANT = "assistant"
_PREFIX = 256
_CONTROL = re.compile(rb"<\\*\|")
_ESCAPED = re.compile(rb"(<\\*)\\\|")


def _escaped_role(role: str) -> bytes:
    raw = role.replace("\\", "\\\\").replace("\n", "\\n").encode()
    return _CONTROL.sub(lambda m: m[0][:-1] + b"\\|", raw)


def unescaped(raw: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1|", raw)


def unescaped_role(raw: bytes) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(raw).decode())


def _copy(out: np.ndarray, to: np.ndarray, source: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copies source[start : start + length] to out[to:], for all rows at once."""
    inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(to, length) + inside] = source[np.repeat(start, length) + inside]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, offset of every turn and the end, begin and end of every turn's text in the buffer)."""
    raw, off = T.column_bytes(texts)
    n = len(off) - 1
    named = pc.fill_null(roles, "").dictionary_encode()
    code = named.indices.to_numpy()
    heads = [TURN + _escaped_role(r) + b"\n" for r in named.dictionary.to_pylist()]
    head_len = np.array([len(h) for h in heads], np.int64)
    head_at = np.cumsum(head_len) - head_len
    head = head_len[code]
    # Places where a backslash goes in, before the bar; matches that run from one row into the next are none.
    spans = np.array([m.span() for m in _CONTROL.finditer(raw.tobytes())], np.int64).reshape(-1, 2)
    row = np.searchsorted(off, spans[:, 0], "right") - 1
    inside = spans[:, 1] <= off[row + 1]
    bar, row = spans[inside, 1] - 1, row[inside]
    more = np.bincount(row, minlength=n)
    body = np.diff(off) + more
    at = np.concatenate((np.zeros(1, np.int64), np.cumsum(head + body + len(END))))
    out = np.empty(at[-1], np.uint8)
    _copy(out, at[:-1], np.frombuffer(b"".join(heads), np.uint8), head_at[code], head)
    put = np.zeros(len(raw) + 1, np.int64)
    put[bar] = 1
    to = np.arange(len(raw)) + np.repeat(at[:-1] + head - off[:-1] - (np.cumsum(more) - more), np.diff(off)) + np.cumsum(put)[:-1]
    out[to] = raw
    out[to[bar] - 1] = ord("\\")
    _copy(out, at[1:] - len(END), np.frombuffer(END, np.uint8), np.zeros(n, np.int64), np.full(n, len(END)))
    return out, at, at[:-1] + head, at[1:] - len(END)


def _pieces(batches):
    """Sorted turns to pieces of conversations, numbered within the partition."""
    last, number, place = None, -1, TaskContext.get().partitionId()
    for part in T.chunks(batches):
        out, at, lo, hi = assemble(part.column(1), part.column(2))
        ids = part.column(0)
        code = ids.dictionary_encode("encode").indices.to_numpy()
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        numbers = np.zeros(len(first), np.int32)
        if (last is not None) and last == (ids[0].as_py(),):
            numbers[0] = number + 1
        last, number = (ids[-1].as_py(),), int(numbers[-1])
        said = np.flatnonzero(pc.fill_null(pc.equal(part.column(1), ASSISTANT), False).to_numpy(zero_copy_only=False))
        piece = np.searchsorted(first, said, "right") - 1
        base = at[first][piece]
        loss = pa.StructArray.from_arrays([pa.array((lo[said] - base).astype(np.int32)), pa.array((hi[said] - base).astype(np.int32))], ["lo", "hi"])
        cut = np.append(at[first], at[-1])
        yield pa.record_batch({
            "conv_id": ids.take(pa.array(first)), "part": pa.array(np.full(len(first), place, np.int32)), "piece": pa.array(numbers),
            "formatted": pa.array([_squeezed(out[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            "loss": pa.ListArray.from_arrays(pa.array(np.searchsorted(said, np.append(first, part.num_rows)).astype(np.int32)), loss)})


def _unpacked_chunks(batches, limit: int = T.CHUNK_BYTES):
    """Slices of the batches whose pieces hold at most `limit` bytes uncompressed (a piece begins with its length), or one piece."""
    for batch in batches:
        sizes = np.cumsum([int.from_bytes(x.as_py()[:8], "little") for x in batch.column(batch.schema.names.index("formatted"))])
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
            yield batch.slice(at, to - at)
            at, done = to, sizes[to - 1]


def _numbered(batches):
    """Pieces in order, numbered along their conversation."""
    last, number = None, -1
    for part in _unpacked_chunks(batches):
        numbers = []
        for i in part.column(0).to_pylist():
            last, number = (i,), number + 1 if last == (i,) else 0
            numbers.append(number)
        yield pa.record_batch({"conv_id": part.column(0), "piece": pa.array(numbers, pa.int32()),
                               "formatted": pa.array([_unsqueezed(x.as_py()) for x in part.column(3)], pa.binary()), "loss": part.column(4)})


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, piece, formatted, loss): a row per conversation; more pieces, in order, for one that spans batches or partitions."""
    kind = rows.schema[conv].dataType.simpleString()
    view = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    # Bounds hold the beginnings of texts.  Rows that are equal in everything are dealt out; those longer than the beginning stay together, after it.
    spread = F.when(F.length("text") > _PREFIX, F.lit((1 << 31) - 1)).otherwise(F.spark_partition_id())
    view = view.withColumn("spread", spread)
    ordered = view.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, _PREFIX), "spread") \
        .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    loss = "loss array<struct<lo:int,hi:int>>"
    pieces = ordered.mapInArrow(_pieces, f"conv_id {kind}, part int, piece int, formatted binary, {loss}")
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece") \
        .mapInArrow(_numbered, f"conv_id {kind}, piece int, formatted binary, {loss}")


def turns_of(formatted: bytes) -> list[tuple[str, bytes]]:
    """(role, text) of every turn of a piece."""
    out = []
    for turn in formatted.split(END)[:-1]:
        role, _, text = turn[len(TURN):].partition(b"\n")
        out.append((unescaped_role(role), unescaped(text)))
    return out


def _points(raw: bytes) -> int:
    return len(raw.decode())


def _digests(batches):
    """Read back from the pieces, which come in order: digests of one conversation at a time."""
    def row(s):
        return {"conv_id": s["id"], "n_turns": s["turns"], "turns_sha256": s["all"].hexdigest(), "loss_chars": s["loss_chars"],
                "loss_sha256": s["loss"].hexdigest(), "formatted_chars": s["chars"]}

    now = None
    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if now is None or r["piece"] == 0:
                done += [row(now)] if now else []
                now = {"id": r["conv_id"], "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
            raw = r["formatted"]
            now["chars"] += _points(raw)
            for role, text in turns_of(raw):
                now["turns"] += 1
                now["all"].update(role.encode() + b"\n" + text + b"\n")
            for span in r["loss"]:
                text = unescaped(raw[span["lo"]:span["hi"]])
                now["loss"].update(text)
                now["loss_chars"] += _points(text)
        yield _rows(done, batch.schema.field("conv_id").type)
    if now is not None:
        yield _rows([row(now)], batch.schema.field("conv_id").type)


def _rows(rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", kind), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                                                       ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7 whose texts hold control strings; digests read back from the formatted bytes."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    pieces = format_conversations(rows.unionByName(more))
    return pieces.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 17
                + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
