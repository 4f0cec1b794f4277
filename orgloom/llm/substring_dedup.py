"""Removal of passages that repeat anywhere in a corpus, by level-wise doubling.

Every window of ``window`` words is a candidate at first. Each level looks at
stretches of about twice the length of the level before (9, 18 and 35 words for a
window of 35): a window stays a candidate only if the stretch that stands for it
occurs elsewhere. The stretch that stands for a window is the one of least hash
inside it, so equal windows pick equal stretches, none is lost, and the short
levels send about one hash for thirteen words. At the last level the stretch is the
window itself, told apart by 128 bits.

Documents are staged once, in blocks that are buckets of a table, so that each
level reads them without moving text. A block sends each of its hashes once, with
a mark if the block itself repeats it, so a passage in a third of all documents
costs one row for each block. The answer to a block is one bit for each hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, MOST_BUCKETS, SPACE, WordHasher, chunks_of, keep_columns, materialize, mix, stage, window_hashes, word_spans

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_ZERO = np.uint64(0)
_SPREAD = np.uint64(0x5851F42D4C957F2D)
_hash, _other_hash = WordHasher(11), WordHasher(43)
#: Bytes of text that one pass works on.
_CHUNK = 1 << 20


def levels_of(window: int, shortest: int = 8) -> list[int]:
    """Lengths of the levels: the window, half of it rounded up, and so on down to ``shortest`` or more."""
    out = [window]
    while (out[0] + 1) // 2 >= shortest:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _slide(x: np.ndarray, span: int, f) -> np.ndarray:
    """f over x[i : i + span], by doubling; as many entries as whole spans."""
    have = 1
    while have * 2 <= span:
        x = f(x[:-have], x[have:])
        have *= 2
    rest = span - have
    return f(x[: len(x) - rest], x[rest:]) if rest else x


class _Piece:
    """Words of some documents of a block, and which of their windows are still candidates."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, window: int):
        st, en, first = word_spans(data, offs, SPACE)
        self.window, self.first, self.n = window, first, len(st)
        self.words, self.others = _hash(data, st, en), _other_hash(data, st, en)
        counts = np.diff(first)
        left = np.repeat(first[1:], counts) - np.arange(self.n)  # words from here to the end of the document
        self.live = (left >= window)[: max(0, self.n - window + 1)]

    def picks(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where live windows pick their stretch of k words, hashes there, second hashes there)."""
        h = window_hashes(self.words, k) | np.uint64(1)
        span = self.window - k + 1
        least = np.where(self.live, _slide(h, span, np.minimum), _ZERO)
        edge = np.zeros(span - 1, np.uint64)
        picked = _slide(np.concatenate([edge, least, edge]), span, np.maximum) == h
        return picked, h[picked], window_hashes(self.others, k)[picked]

    def keep(self, k: int, picked: np.ndarray, h: np.ndarray, twice: np.ndarray) -> None:
        """Windows whose stretch does not occur twice are given up."""
        span, every, some = self.window - k + 1, np.full(len(picked), _TOP, np.uint64), np.full(len(picked), _TOP, np.uint64)
        every[picked] = h
        some[picked] = np.where(twice, h, _TOP)
        some = _slide(some, span, np.minimum)
        self.live &= (some == _slide(every, span, np.minimum)) & (some != _TOP)


def _classes(h: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct pairs, the place of each pair among them, and how often each occurs."""
    order = np.argsort(h, kind="stable")
    a, b = h[order], two[order]
    same = a[1:] == a[:-1]
    if (same & (b[1:] != b[:-1])).any():  # first hashes that agree by chance
        order = np.lexsort((two, h))
        a, b = h[order], two[order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    new = np.ones(len(a), bool)
    np.logical_not(same, out=new[1:])
    group = np.cumsum(new, dtype=np.int32) - np.int32(1)
    inverse = np.empty(len(a), np.int32)
    inverse[order] = group
    return a[new], b[new], inverse, np.bincount(group)


def _walk(texts: pa.Array, window: int, levels: list[int], answers: dict[int, dict[int, bytes]], buckets: int):
    """Goes through the levels that ``answers`` has; gives the pieces and the distinct hashes of the next level, if there is one."""
    pieces = [_Piece(data, offs, window) for _, _, data, offs in chunks_of(texts, _CHUNK)]
    for level, k in enumerate(levels):
        alive = [p for p in pieces if p.live.any()]
        if not alive:
            return pieces, None
        found = [p.picks(k) for p in alive]
        if level not in answers:
            found = [(None, h, two) for _, h, two in found]
        # Least hashes are small numbers; mixed again, they spread evenly over the buckets.
        a, b, inverse, counts = _classes(mix(np.concatenate([x[1] for x in found]) ^ _SPREAD), np.concatenate([x[2] for x in found]))
        cuts = _cuts(a, buckets)
        if level not in answers:
            return pieces, (a, b, counts > 1, cuts)
        flags = np.zeros(len(a), bool)
        for bucket, bits in answers[level].items():
            s, e = cuts[bucket], cuts[bucket + 1]
            flags[s:e] = np.unpackbits(np.frombuffer(bits, np.uint8), count=e - s).astype(bool)
        at = 0
        for p, (picked, h, _) in zip(alive, found, strict=True):
            p.keep(k, picked, h, flags[inverse[at : at + len(h)]])
            at += len(h)
    return pieces, None


def _cuts(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]]).astype(np.int64)


def _answers(table: pa.Table) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {}
    for level, bucket, bits in zip(*(table.column(c).to_pylist() for c in ("level", "bucket", "bits")), strict=True):
        out.setdefault(level, {})[bucket] = bits
    return out


def repeated_passages(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, shortest: int = 8) -> DataFrame:
    """(doc_id, n_words, n_removed, spans array<struct<start,end>>, kept_text): one row for each row of ``docs``.

    Words are runs of bytes outside the six ASCII spaces. A word goes if any window that covers it
    starts anywhere else too, in the same text or another; spans count words. Null, empty and blank
    texts have no words and an empty ``kept_text``; texts shorter than the window stay; repeated rows
    repeat each other; an empty table gives an empty result; other columns are not looked at.
    Words and windows are told apart by two hashes of 64 bits.

    block_bytes: about the bytes of text of a block, which a Python worker holds, with some twenty times its words; a longer text is a block of its own size."""
    spark: SparkSession = docs.sparkSession
    slim = keep_columns(docs, id_col, text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()
    levels = levels_of(window, shortest)
    staged, blocks = stage(slim, "text", "block", block_bytes)
    buckets = min(blocks, MOST_BUCKETS)
    answers = spark.createDataFrame([], "block long, level int, bucket int, bits binary")

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: dict[str, list] = {"bucket": [], "block": [], "hashes": [], "marks": []}
        if left.num_rows:
            known = _answers(right)
            if known or not right.num_rows:
                _, wanted = _walk(left.column("text"), window, levels, known, buckets)
                if wanted:
                    a, b, marks, cuts = wanted
                    pairs = np.stack([a, b])
                    for i in np.flatnonzero(np.diff(cuts)):
                        s, e = cuts[i], cuts[i + 1]
                        rows["bucket"].append(int(i))
                        rows["block"].append(left.column("block")[0].as_py())
                        rows["hashes"].append(pairs[:, s:e].tobytes())
                        rows["marks"].append(np.packbits(marks[s:e]).tobytes())
        return pa.table(rows, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("marks", pa.binary())]))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        n_words, n_removed, spans, kept = [], [], [], []
        if left.num_rows:
            texts = left.column("text").combine_chunks()
            pieces, _ = _walk(texts, window, levels, _answers(right), buckets)
            for (_, _, data, offs), p in zip(chunks_of(texts, _CHUNK), pieces, strict=True):
                change = np.zeros(p.n + 1, np.int64)
                at = np.flatnonzero(p.live)
                np.add.at(change, at, 1)
                np.subtract.at(change, at + window, 1)
                gone = np.cumsum(change[:-1]) > 0
                st, en, first = word_spans(data, offs, SPACE)
                raw = data.tobytes()
                for d in range(len(offs) - 1):
                    s, e = first[d], first[d + 1]
                    g = gone[s:e]
                    n_words.append(int(e - s))
                    n_removed.append(int(g.sum()))
                    if g.any():
                        edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]])))
                        spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
                        rest = np.flatnonzero(~g) + s
                        kept.append(b" ".join([raw[x:y] for x, y in zip(st[rest].tolist(), en[rest].tolist(), strict=True)]).decode())
                    else:
                        spans.append([])
                        kept.append(b" ".join(raw[offs[d] : offs[d + 1]].split()).decode())
        return pa.table(
            {"doc_id": left.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
             "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), "kept_text": pa.array(kept, pa.string())}
        )

    def judge(table: pa.Table) -> pa.Table:
        blocks_in, parts = table.column("block").to_pylist(), [np.frombuffer(x, np.uint64).reshape(2, -1) for x in table.column("hashes").to_pylist()]
        marks = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=p.shape[1]) for m, p in zip(table.column("marks").to_pylist(), parts, strict=True)]).astype(bool)
        _, _, inverse, counts = _classes(*np.concatenate(parts, axis=1))
        twice = counts > 1
        twice[inverse[marks]] = True
        flags = twice[inverse]
        cuts = np.cumsum([0, *(p.shape[1] for p in parts)])
        bits = [np.packbits(flags[s:e]).tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
        bucket = table.column("bucket").to_pylist()
        return pa.table({"block": pa.array(blocks_in, pa.int64()), "bucket": pa.array(bucket, pa.int32()), "bits": pa.array(bits, pa.binary())})

    for level in range(len(levels)):
        sent = staged.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(send, "bucket int, block long, hashes binary, marks binary")
        said = sent.groupBy("bucket").applyInArrow(judge, "block long, bucket int, bits binary")
        new = materialize(said.select("block", F.lit(level).alias("level"), "bucket", "bits"), f"level{level}")
        answers = answers.union(new) if level else new
    return staged.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string")
