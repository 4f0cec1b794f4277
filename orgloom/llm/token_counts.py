"""Token counts of whole texts, for budgets and length filters.

Arrow batches are cut into pieces of about equal bytes; texts, however long, are
split at safe boundaries into short pieces, and only the distinct pieces that the
task has not met are encoded, in batches of about equal bytes. Nothing but lengths is kept.
"""

from __future__ import annotations

import itertools
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_of, keep_columns, tidied
from .pieces import LETTERS, Recent, byte_level, cut_long, no_garbage_collection, split_words, word_level, worker_store

#: Bytes of each generation of words, and of pieces, that a task remembers.
REMEMBERED = 24 << 20


def read_tokenizer(path: str) -> tuple[str, bytes]:
    """(kind, contents) of a tokenizer file: 'json' for the tokenizers library, 'model' for sentencepiece."""
    with open(path, "rb") as f:
        return path.rsplit(".", 1)[-1], f.read()


def _tokenizers_counter(contents: bytes) -> Callable[[list[bytes]], list[int]]:
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(contents.decode())
    t.no_truncation()
    t.no_padding()
    return lambda texts: [len(x) for x in t.encode_batch_fast([p.decode() for p in texts], add_special_tokens=False)]


def _piece_counter(contents: bytes) -> Callable[[list[bytes]], list[int]]:
    """Counts of pieces. Letters-only pieces, of which the last token alone closes a word, are encoded many in one text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(contents.decode())
    t.no_truncation()
    t.no_padding()
    suffix = json.loads(contents)["model"].get("end_of_word_suffix")
    closes = np.zeros(t.get_vocab_size(), bool)
    if suffix:
        closes[[i for token, i in t.get_vocab().items() if token.endswith(suffix)]] = True

    def count(pieces: list[bytes]) -> list[int]:
        out = [0] * len(pieces)
        texts = [p.decode() for p in pieces]
        plain = [i for i, x in enumerate(texts) if suffix and LETTERS.fullmatch(x)]
        ids = np.array(t.encode_batch_fast([" ".join([texts[i] for i in plain])], add_special_tokens=False)[0].ids if plain else [], np.int64)
        for i, n in zip(plain, np.diff(np.flatnonzero(closes[ids]), prepend=-1).tolist(), strict=True):
            out[i] = n
        rest = [i for i in range(len(texts)) if not out[i]]
        for i, x in zip(rest, t.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = len(x)
        return out

    return count


def _sentencepiece_counter(contents: bytes) -> Callable[[list[bytes]], list[int]]:
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_proto=contents)
    return lambda pieces: [len(x) for x in p.encode([x.decode() for x in pieces], num_threads=1)]


def even_batches(pieces: list[bytes], limit: int) -> Iterator[list[bytes]]:
    """Batches of at most ``limit`` bytes; a longer piece is a batch of its own."""
    batch, size = [], 0
    for p in pieces:
        if batch and size + len(p) > limit:
            yield batch
            batch, size = [], 0
        batch.append(p)
        size += len(p)
    if batch:
        yield batch


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 18, cut_bytes: int = 1 << 16) -> DataFrame:
    """(doc_id, n_bytes long, n_tokens long): one row for each row of ``docs``, in its partitions.

    Word-level tokenizers (see ``pieces``) encode distinct words; byte-level ones encode texts in parts of about
    ``cut_bytes``; others, and sentencepiece models, whole texts. Null counts as empty: no bytes, and no tokens; repeated rows each get
    their row; an empty table gives an empty result; other columns are not looked at. Invalid surrogates
    can't occur in Arrow strings."""
    slim = keep_columns(docs, id_col, text_col)
    kind, contents = read_tokenizer(path)
    given = slim.sparkSession.sparkContext.broadcast(contents)  # of the size of the file
    spec = json.loads(contents) if kind == "json" else {}
    by_word, may_cut = bool(spec) and word_level(spec), bool(spec) and byte_level(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store()
        key = f"token_counts {kind} {by_word} {zlib.crc32(given.value)}"
        if key not in store:
            store[key] = (_sentencepiece_counter if kind == "model" else _piece_counter if by_word else _tokenizers_counter)(given.value)
        count, words, pieces = store[key], Recent(REMEMBERED), Recent(REMEMBERED)
        with no_garbage_collection():
            for b in batches:
                for at, to, data, offs in chunks_of(b.column(1)):
                    raw, ends = data.tobytes(), offs.tolist()
                    if by_word:
                        rows = [raw[s:e].split() for s, e in zip(ends[:-1], ends[1:], strict=True)]
                        new = words.missing(set().union(*rows))
                        cut = split_words(new)
                        for part in even_batches(pieces.missing({p for x in cut for p in x}), batch_bytes):
                            pieces.learn(dict(zip(part, count(part), strict=True)))
                        of = pieces.new
                        words.learn({w: of[x[0]] if len(x) == 1 else sum([of[p] for p in x]) for w, x in zip(new, cut, strict=True)})
                        of = words.new.__getitem__
                        n = [sum(map(of, x)) for x in rows]
                    else:
                        texts = [raw[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]
                        cuts = [cut_long(t, cut_bytes) if may_cut else [t] for t in texts]
                        each = iter([k for part in even_batches([p for x in cuts for p in x], batch_bytes) for k in count(part)])
                        n = [sum(itertools.islice(each, len(x))) for x in cuts]
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, to - at), pa.array(np.diff(offs), pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return slim.mapInArrow(tidied(run), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")


def over_limit(counts: DataFrame, limit: int = 2048) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
