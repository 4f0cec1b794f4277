r"""Chat formatting by columnar byte assembly.

A turn becomes ``### role:\ntext</turn>\n``. Every backslash, # and < inside a role or text (and : in a
role) gets a backslash before it, so no text can pass for a header or an end, and dropping those
backslashes gives the text back. Lengths of all segments of a batch are computed first; cumulative sums
are their offsets; headers and contents are scattered into one preallocated buffer, whose slices are the
formatted conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks_of

HEAD, MIDDLE, TAIL = b"### ", b":\n", b"</turn>\n"
#: Turns of a conversation that are formatted together; a longer conversation is split over tasks.
SEGMENT = 1024
#: Possessive, so that no place is kept to go back to, however long the text.
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+):\n((?:[^\\<]++|\\.)*+)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def escaped(data: np.ndarray, offs: np.ndarray, signs: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with a backslash before each of ``signs``, and the rows' offsets in them."""
    table = np.zeros(256, bool)
    table[np.frombuffer(signs, np.uint8)] = True
    marked = table[data]
    more = np.concatenate([np.zeros(1, np.int64), np.cumsum(marked)])
    place = np.arange(len(data)) + more[1:]
    out = np.full(len(data) + int(more[-1]), ord("\\"), np.uint8)
    out[place] = data
    return out, offs + more[offs]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, start of each turn and the end of the last, start and end of each turn's text)."""
    parts = [escaped(*_bytes_of(roles), b"\\#<:"), escaped(*_bytes_of(texts), b"\\#<")]
    n = len(roles)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(HEAD), len(MIDDLE), len(TAIL)
    lengths[:, 1], lengths[:, 3] = (np.diff(o) for _, o in parts)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    starts = ends - lengths
    buffer = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for column, fixed in ((0, HEAD), (2, MIDDLE), (4, TAIL)):
        buffer[starts[:, column, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    for column, (data, offs) in ((1, parts[0]), (3, parts[1])):
        buffer[np.repeat(starts[:, column] - offs[:-1], lengths[:, column]) + np.arange(len(data))] = data
    return buffer, np.concatenate([starts[:, 0], ends[-1:, -1]]), np.stack([starts[:, 3], ends[:, 3]], axis=1)


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_roles: tuple[str, ...] = ("assistant",), chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(conv_id, n_turns long, formatted string, loss_spans array<struct<start,end>>): one row for each conversation.

    Spans count code points of ``formatted`` and cover the texts of ``loss_roles``. Turns are in order of
    ``turn``, then role, then text; repeated rows are turns of their own; null turns come first; null roles and
    texts are empty; a null id is a conversation too; an empty table gives an empty result; other columns
    are not looked at."""
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("segment", F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(-(1 << 40))).cast("long"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = rows.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "turn", "role", "text").select("conv_id", "segment", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = 0
        for whole in batches:
            for at, to, _, _ in chunks_of(whole.column(3), chunk_bytes):
                b = whole.slice(at, to - at)
                buffer, turn_at, spans = assemble(b.column(2), b.column(3))
                key = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
                first = np.array([i for i in range(len(key)) if not i or key[i] != key[i - 1]], np.int64)
                ends = np.append(first[1:], len(key))
                chars = np.concatenate([np.zeros(1, np.int64), np.cumsum((buffer & 0xC0) != 0x80)])
                lost = np.isin(np.asarray(b.column(2).to_pylist(), object), loss_roles)
                loss = [
                    [{"start": int(chars[s] - chars[turn_at[f]]), "end": int(chars[e] - chars[turn_at[f]])} for s, e in spans[f:t][lost[f:t]].tolist()]
                    for f, t in zip(first.tolist(), ends.tolist(), strict=True)
                ]
                if turn_at[-1] >= 1 << 31:
                    raise OverflowError(f"{turn_at[-1]} bytes of one turn do not fit a string")
                offsets = pa.py_buffer(np.append(turn_at[first], turn_at[-1]).astype(np.int32))
                formatted = pa.StringArray.from_buffers(len(first), offsets, pa.py_buffer(buffer))
                part += 1
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(first)), b.column(1).take(pa.array(first)), pa.array([part] * len(first), pa.int64()), pa.array(ends - first, pa.int64()), formatted,
                     pa.array(loss, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    ["conv_id", "segment", "part", "n", "formatted", "loss"],
                )

    parts = dealt.mapInArrow(run, f"conv_id {kind}, segment long, part long, n long, formatted string, loss array<struct<start:bigint,end:bigint>>")
    grouped = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("segment", "part", "n", "formatted", "loss"))).alias("p"))
    # Where each part begins; then all of its spans are moved at once.
    begin = F.aggregate(
        "p", F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out")),
        lambda s, x: F.struct((s["at"] + F.length(x["formatted"])).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"],
    )
    moved = F.flatten(F.zip_with("p", begin, lambda x, at: F.transform(x["loss"], lambda y: F.struct((y["start"] + at).alias("start"), (y["end"] + at).alias("end")))))
    return grouped.select("conv_id", F.aggregate("p", F.lit(0).cast("bigint"), lambda s, x: s + x["n"]).alias("n_turns"), F.array_join(F.transform("p", lambda x: x["formatted"]), "").alias("formatted"), moved.alias("loss_spans"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; the whole string must be turns."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) as the output itself has them."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for whole, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                turns = parse(whole)
                loss = "".join([unescape(whole[s["start"] : s["end"]]) for s in spans])
                rows.append((len(turns), hashlib.sha256("".join([f"{r}\n{t}\n" for r, t in turns]).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole)))
            n, turns_sha, chars, loss_sha, size = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(turns_sha, pa.string()), pa.array(chars, pa.int64()), pa.array(loss_sha, pa.string()), pa.array(size, pa.int64())],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
