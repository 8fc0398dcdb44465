"""Chat formatting by columnar byte assembly, and reading the result back."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.columns import in_bytes

# fixed values of the template
START, END = b"<|im_start|>", b"<|im_end|>"
LOSS_ROLE = b"assistant"

PART_BYTES = 1 << 18  # roles and texts of one row of the result: a longer conversation has several rows
FLUSH_BYTES = 1 << 24  # finished parts that a task gathers before it hands them on
BLOCK = 1 << 22  # bytes fetched by one index array

_MARK = re.compile(rb"<(\\*)\|")
_MARKED = re.compile(rb"<\\(\\*)\|")
_ROLE = re.compile(rb"\\(.)", re.DOTALL)
_TO_ROLE = {b"\\": b"\\\\", b"\n": b"\\n", b"|": b"\\p"}
_FROM_ROLE = {v[1:]: k for k, v in _TO_ROLE.items()}


def escaped(text: bytes) -> bytes:
    """A text without the opening of any mark: <| gets a backslash inside, <\\| one more, and so on."""
    return _MARK.sub(rb"<\\\1|", text) if b"<" in text else text


def unescaped(text: bytes) -> bytes:
    return _MARKED.sub(rb"<\1|", text) if b"<" in text else text


def escaped_role(role: bytes) -> bytes:
    """A role in one line and without marks."""
    return re.sub(rb"[\\\n|]", lambda m: _TO_ROLE[m[0]], role)


def unescaped_role(role: bytes) -> bytes:
    return _ROLE.sub(lambda m: _FROM_ROLE[m[1]], role)


def assemble(roles: list[bytes], texts: list[bytes], turns_per_chat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all chats, their offsets, start and end of each text in the bytes).

    A turn is four segments: opening with the role, text, close, and line end. Their lengths give
    cumulative offsets; every byte of the result is then fetched by index from a pool that holds
    each header once and the texts in a row, into an array made beforehand, BLOCK bytes at a time.
    """
    kinds = {r: k for k, r in enumerate(dict.fromkeys(roles))}
    heads = [START + escaped_role(r) + b"\n" for r in kinds]
    bodies = [escaped(t) for t in texts]
    tail = END + b"\n"
    pool = np.frombuffer(b"".join([*heads, tail, *bodies]), np.uint8)
    head_len = np.array([len(h) for h in heads], np.int64)
    head_at = np.concatenate([[0], np.cumsum(head_len)[:-1]]) if heads else head_len
    tail_at = int(head_len.sum())
    body_len = np.fromiter((len(b) for b in bodies), np.int64, len(bodies))
    body_at = tail_at + len(tail) + np.cumsum(body_len) - body_len
    kind = np.fromiter((kinds[r] for r in roles), np.int64, len(roles))
    lengths = np.stack([head_len[kind], body_len, np.full(len(roles), len(tail))], 1).ravel() if roles else np.zeros(0, np.int64)
    sources = np.stack([head_at[kind], body_at, np.full(len(roles), tail_at)], 1).ravel() if roles else np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    out = np.empty(total, np.uint8)
    starts = ends - lengths
    for low in range(0, total, BLOCK):
        high = min(low + BLOCK, total)
        some = slice(np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left"))
        index = np.repeat((sources - starts)[some], np.minimum(ends[some], high) - np.maximum(starts[some], low))
        index += np.arange(low, high)
        np.take(pool, index, out=out[low:high])
    turn_ends = np.concatenate([[0], ends[2::3]])
    chat_ends = np.concatenate([[0], np.cumsum(turns_per_chat)]).astype(np.int64)
    return out, turn_ends[chat_ends], ends[1::3] - body_len, ends[1::3]


SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("loss_spans", T.ArrayType(T.LongType())),
    ]
)


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """(conv_id, part, formatted, loss_spans): a row for each conversation, part 0, or several where its roles
    and texts exceed part_bytes; loss_spans holds start and end of each assistant text in the UTF-8
    bytes of that row's formatted.

    Turns are dealt by conversation and sorted by turn, role and text (nulls first), then assembled
    as they arrive. Parts hold whole turns and follow each other in order; joined, they are the
    conversation. Memory follows one Arrow batch and one part, however long a conversation is; a
    single turn of more than part_bytes is a part of its own. Control strings in texts and roles
    are escaped reversibly. Null role or text: empty. Null conv_id: a conversation of its own.
    Repeated rows are turns of their own. No turns, no rows; other columns are left out.
    """

    def made(rows: list[tuple]) -> pa.RecordBatch:
        first = [k for k in range(len(rows)) if k == 0 or rows[k][:2] != rows[k - 1][:2]]
        counts = np.diff([*first, len(rows)])
        buffer, offsets, starts, ends = assemble([r[2] for r in rows], [r[3] for r in rows], counts)
        if len(buffer) > 2**31 - 1:
            raise ValueError("a turn that is too long for a Spark string once escaped")
        formatted = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(buffer))
        scored = np.fromiter((r[2] == LOSS_ROLE for r in rows), bool, len(rows))
        chat = np.repeat(np.arange(len(counts)), counts)
        base = offsets[:-1][chat]
        spans = np.stack([starts - base, ends - base], 1)[scored].ravel()
        per_chat = np.bincount(chat[scored], minlength=len(counts)) * 2
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_chat)]), pa.int32()), pa.array(spans, pa.int64()))
        keys = [pa.array([rows[k][i] for k in first], pa.int64()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*keys, formatted, lists], names=SCHEMA.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # turns of finished parts, then those of the open one from `begin` on
        begin = done = size = part = 0  # done, size: bytes in finished parts and in the open one
        for batch in batches:
            for conv_id, who, said in zip(batch.column(0).to_pylist(), in_bytes(batch.column(1)), in_bytes(batch.column(2)), strict=True):
                more = len(who) + len(said)
                other = bool(held) and held[-1][0] != conv_id
                if held and (other or size + more > part_bytes):
                    begin, done, size, part = len(held), done + size, 0, 0 if other else part + 1
                    if done > FLUSH_BYTES:
                        yield made(held)
                        first = (conv_id, part, who, said)
                        held, begin, done, size = [first], 0, 0, more
                        continue
                held.append((conv_id, part, who, said))
                size += more
            if begin:
                yield made(held[:begin])
                held, begin, done = held[begin:], 0, 0
        if held:
            yield made(held)

    clean = turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.col(turn).alias("turn"),
    )
    dealt = clean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, SCHEMA)


def parsed(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """The turns of a formatted conversation, (role, text) as they came in."""
    out = []
    for piece in formatted.split(START)[1:]:
        role, body = piece.split(b"\n", 1)
        out.append((unescaped_role(role), unescaped(body[: -len(END) - 1])))
    return out


def read_chats(chats: DataFrame) -> DataFrame:
    """What formatted conversations hold, by reading them: conv_id, n_turns, turns_sha256 (role, line
    end, text, line end of each turn), loss_chars and loss_sha256 (the texts under the mask, in
    order), formatted_chars. The parts of a conversation pass one by one, in order, through running
    digests, which can't be taken in pieces; no more than an Arrow batch is held."""
    import hashlib

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    def run(batches):
        conv = whole = loss = None
        n_turns = loss_chars = chars = 0
        for batch in batches:
            out = []
            for conv_id, data, spans in zip(batch.column(0).to_pylist(), in_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                if whole is None or conv_id != conv:
                    if whole is not None:
                        out.append((conv, n_turns, whole.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    conv, whole, loss = conv_id, hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = chars = 0
                for role, text in parsed(data):
                    whole.update(role + b"\n" + text + b"\n")
                    n_turns += 1
                for s, e in zip(spans[::2], spans[1::2], strict=True):
                    text = unescaped(data[s:e])
                    loss.update(text)
                    loss_chars += len(text.decode())
                chars += len(data.decode())
            if out:
                yield batch_of(out)
        if whole is not None:
            yield batch_of([(conv, n_turns, whole.hexdigest(), loss_chars, loss.hexdigest(), chars)])

    parts = chats.select("conv_id", "part", "formatted", "loss_spans").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.select("conv_id", "formatted", "loss_spans").mapInArrow(run, schema)
