"""Benchmark decontamination over a distributed positional inverted index.

Training documents are indexed in blocks: a row of the index holds the distinct terms of
some documents and the sorted positions of each. The index is a written table of the whole corpus, which
any number of test sets can search. The search takes, block by block, the postings of each
phrase's rarest term less its offset as candidate starts, and intersects them with the postings of its next
rarest terms, each less its own offset, until all terms of the phrase are met (exact phrases), or met within
``slop`` words of their place (proximity). A phrase of which a block lacks a term is left at once.

The tests go to the executors in packs of at most ``pack_bytes``; a larger test
set only makes more packs, and a task holds one at a time. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_WORD, WordHasher, chunks_of, keep_columns, materialize, tidied, word_spans

WINDOW = 13
_hash = WordHasher(5, lower=True)
INDEX_SCHEMA = "docs array<{kind}>, first binary, n_words binary, terms binary, counts binary, postings binary"
_NONE = np.zeros(0, np.int64)


def phrases_of(items: list[tuple[str, str]], window: int) -> dict:
    """The distinct windows of some test items, as plain arrays: ``vocabulary`` (sorted hashes), ``terms`` (places in it, -1 past the end), ``length``, and the items of each window."""
    seen: dict[bytes, int] = {}
    spans, owners = [], []
    for number, (_, text) in enumerate(items):
        data = np.frombuffer(text.encode(), np.uint8)
        st, en, _ = word_spans(data, np.array([0, len(data)]), NON_WORD)
        words = _hash(data, st, en)
        for i in range(max(1, len(words) - window + 1) if len(words) else 0):
            part = words[i : i + window]
            key = part.tobytes()
            if key not in seen:
                seen[key] = len(spans)
                spans.append(part)
            owners.append((seen[key], number))
    pairs = np.unique(np.array(owners, np.int64).reshape(-1, 2), axis=0)
    vocabulary = np.unique(np.concatenate(spans)) if spans else np.zeros(0, np.uint64)
    terms = np.full((len(spans), window), -1, np.int32)
    for i, x in enumerate(spans):
        terms[i, : len(x)] = np.searchsorted(vocabulary, x)
    return {
        "items": [i for i, _ in items], "vocabulary": vocabulary, "terms": terms, "length": (terms >= 0).sum(axis=1),
        "owner_of": pairs[:, 1], "owner_at": np.searchsorted(pairs[:, 0], np.arange(len(spans) + 1)),
    }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = WINDOW + 1) -> DataFrame:
    """The index of ``docs``: a row for each block of about 2 MB of text.

    ``first`` and ``n_words`` (int32): position of each document's first word, and its words; ``gap`` positions between documents belong to
    none, so no phrase crosses them. ``terms``: sorted hashes of all words of the block; ``counts`` and
    ``postings`` (int32): how often each occurs and where, by term."""
    slim = keep_columns(docs, id_col, text_col)
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, data, offs in chunks_of(b.column(1)):
                st, en, first = word_spans(data, offs, NON_WORD)
                n = np.diff(first)
                start = first[:-1] + np.arange(to - at) * gap
                place = (np.arange(len(st)) + np.repeat(np.arange(to - at) * gap, n)).astype(np.int32)
                h = _hash(data, st, en)
                order = np.argsort(h, kind="stable")
                h = h[order]
                cuts = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else _NONE
                counts = np.diff(np.append(cuts, len(h)))
                made = [start.astype(np.int32), n.astype(np.int32), h[cuts], counts.astype(np.int32), place[order]]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, to - at], pa.int32()), b.column(0).slice(at, to - at)), *[pa.array([x.tobytes()], pa.binary()) for x in made]],
                    ["docs", "first", "n_words", "terms", "counts", "postings"],
                )

    return slim.mapInArrow(tidied(run), INDEX_SCHEMA.format(kind=kind))


def _meet(phrases: dict, terms: np.ndarray, counts: np.ndarray, places: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of each phrase of a block."""
    vocabulary, length = phrases["vocabulary"], phrases["length"]
    if not len(terms) or not len(length):
        return _NONE, _NONE
    slot = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
    slot = np.append(np.where(terms[slot] == vocabulary, slot, -1), -2)  # -1: the block lacks the term; the last, for places past the end, -2
    term = slot[phrases["terms"]]
    window = np.flatnonzero((term != -1).all(axis=1))
    if not len(window):
        return _NONE, _NONE
    term = term[window]
    common = np.append(counts.astype(np.int64), [np.iinfo(np.int64).max] * 2)  # -2 is the last but one
    order = np.argsort(common[term], axis=1, kind="stable")  # rarest first; places past the end come last
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)])
    keyed = (np.repeat(np.arange(len(terms)), counts) << 32) + places
    rarest = order[:, 0]
    lead = term[np.arange(len(term)), rarest]
    n = counts[lead].astype(np.int64)
    which = np.repeat(np.arange(len(window)), n)
    within = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    start = places[np.repeat(begin[lead], n) + within].astype(np.int64) - rarest[which]
    for r in range(1, term.shape[1]):
        if not len(which):
            break
        place = order[which, r]
        t = term[which, place]
        want = (t << 32) + np.maximum(start + place - slop, 0)
        at = np.minimum(np.searchsorted(keyed, want), len(keyed) - 1)
        ok = (t < 0) | ((keyed[at] >= want) & (keyed[at] <= (t << 32) + start + place + slop))
        which, start = which[ok], start[ok]
    return window[which], start


def search(index: DataFrame, packs: list, slop: int = 0, matches: bool = True) -> DataFrame:
    """(doc_id, n_words, n_hit, items array<string>, matches array<struct<item,start>>): a row for each indexed document.

    packs: broadcasts of ``phrases_of``. ``n_hit``: words inside matches (with ``slop``: inside the windows' places). ``matches``: where a window
    of an item starts, in words of the document; null if not wanted."""
    kind = index.schema["docs"].dataType.elementType.simpleString()
    span_type = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                docs = b.column(0)[row].values
                first, n_words, counts, places = (np.frombuffer(b.column(c)[row].as_py(), np.int32) for c in (1, 2, 4, 5))
                terms, first, n_words = np.frombuffer(b.column(3)[row].as_py(), np.uint64), first.astype(np.int64), n_words.astype(np.int64)
                change = np.zeros(int(first[-1] + n_words[-1]) + 2 if len(first) else 2, np.int64)
                items: dict[int, set[str]] = {}
                spans: dict[int, list] = {}
                for pack in packs:
                    phrases = pack.value
                    if len(packs) > 1:
                        pack.__dict__.pop("_value", None)  # the next block loads it again
                    which, start = _meet(phrases, terms, counts, places, slop)
                    if not len(which):
                        continue
                    doc = np.searchsorted(first, start + (phrases["length"][which] - 1 if slop else 0), "right") - 1
                    # of several documents without words at one place, the last has the words
                    inside = start >= first[doc] if not slop else np.ones(len(doc), bool)
                    which, start, doc = which[inside], np.maximum(start[inside], first[doc[inside]]), doc[inside]
                    end = np.minimum(start + phrases["length"][which], first[doc] + n_words[doc])
                    change += np.bincount(start, minlength=len(change)) - np.bincount(end, minlength=len(change))
                    each = np.diff(phrases["owner_at"])[which]
                    owner = phrases["owner_of"][np.repeat(phrases["owner_at"][which] - (np.cumsum(each) - each), each) + np.arange(each.sum())]
                    for d, o in np.unique(np.stack([np.repeat(doc, each), owner], axis=1), axis=0).tolist():
                        if phrases["items"][o] is not None:
                            items.setdefault(d, set()).add(phrases["items"][o])
                    if matches:
                        for d, o, s in zip(np.repeat(doc, each).tolist(), owner.tolist(), np.repeat(start - first[doc], each).tolist(), strict=True):
                            spans.setdefault(d, []).append({"item": phrases["items"][o], "start": s})
                covered = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.cumsum(change) > 0)])
                n = range(len(docs))
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(n_words, pa.int64()), pa.array(covered[first + n_words] - covered[first], pa.int64()), pa.array([sorted(items.get(d, ())) for d in n], pa.list_(pa.string())),
                     pa.array([spans.get(d, []) if matches else None for d in n], span_type)],
                    ["doc_id", "n_words", "n_hit", "items", "matches"],
                )

    return index.mapInArrow(tidied(run), f"doc_id {kind}, n_words long, n_hit long, items array<string>, matches array<struct<item:string,start:int>>")


def packs_of(tests: DataFrame, id_col: str, text_col: str, window: int, pack_bytes: int) -> Iterator[dict]:
    """``phrases_of`` the tests, pack by pack."""
    items, size = [], 0
    for r in keep_columns(tests, id_col, text_col).filter("text IS NOT NULL").orderBy(F.col("doc_id").cast("string"), "text").toLocalIterator():
        items.append((None if r["doc_id"] is None else str(r["doc_id"]), r["text"]))
        size += len(r["text"].encode()) * window
        if size > pack_bytes:
            yield phrases_of(items, window)
            items, size = [], 0
    if items:
        yield phrases_of(items, window)


def contamination(docs: DataFrame, tests: DataFrame, window: int = WINDOW, slop: int = 0, id_col: str = "doc_id", text_col: str = "text", test_id: str = "item_id", test_text: str = "text", pack_bytes: int = 64 << 20, matches: bool = True) -> DataFrame:
    """What of ``tests`` occurs in ``docs``: see ``search``; one row for each row of ``docs``.

    Words are runs of lower-cased letters, digits and bytes over 0x7F. A test of fewer words than
    ``window`` is one window; of none, it never matches. Null, empty and blank documents have no words and
    no hits; repeated rows each get their row; tests of one id count as one item; words of a test without an id are hit, but it is no item
    (its matches have a null one); an empty table of either
    kind gives no hits; other columns are not looked at."""
    sc = docs.sparkSession.sparkContext
    index = materialize(build_index(docs, id_col, text_col, window + slop + 1), "index")
    return search(index, [sc.broadcast(p) for p in packs_of(tests, test_id, test_text, window, pack_bytes)], slop, matches)


def verdicts(found: DataFrame, share: int = 20) -> DataFrame:
    """Adds n_items, items_sha256 and contaminated: at least one word in ``share`` is hit."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
