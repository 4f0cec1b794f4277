"""Byte-pair encoding by a traversal of a trie of distinct words, and decoding.

A prefix of a word has one valid encoding, and it is found from its last token alone:
that token ends the prefix, what stands before it is encoded as the shorter prefix
is, and the two tokens at the seam must stay apart when merged on their own. The distinct
words of a batch, sorted, are a trie; a walk in depth carries the last token of each prefix
on the path and where it begins, so a prefix that many words share is encoded once. The final
character of a word is a symbol of its own (with the word-end mark), which only closes a path.
Decoding looks up the ids of a text, and knows nothing of the words they came from.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_of, give_back, keep_columns, tidied
from .pieces import LETTERS, Recent, no_garbage_collection, split_words, word_level, worker_store

#: Bytes of each generation of words, and of pieces, that a task remembers.
REMEMBERED = 20 << 20


def byte_characters() -> list[str]:
    """Of each byte, the printable character that stands for it in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


def shared_lengths(words: list[str], width: int = 24) -> list[int]:
    """Of each word of a sorted list, how many characters it shares with the word before it; 0 for the first."""
    if not words:
        return []
    table = np.array([w[:width] for w in words], f"U{width}").view(np.uint32).reshape(len(words), width)
    same = (table[1:] == table[:-1]) & (table[1:] != 0)
    out = [0, *np.where(same.all(axis=1), width, np.argmin(same, axis=1)).tolist()]
    for i in (np.flatnonzero(same.all(axis=1)) + 1).tolist():  # the few that share more
        a, b, n = words[i - 1], words[i], width
        most = min(len(a), len(b))
        while n < most:
            middle = (n + most + 1) // 2
            if a[n:middle] == b[n:middle]:
                n = middle
            else:
                most = middle - 1
        out[i] = n
    return out


class TrieEncoder:
    """A word-level BPE vocabulary, whose merges put together what earlier merges have made.

    Tokens are numbers: their ids. ``goto`` and ``ends`` are an automaton of the vocabulary: the state after a
    prefix tells which tokens end there, longest first."""

    #: Pairs of tokens, of which it is known whether they stay apart, that are remembered.
    KNOWN_PAIRS = 1 << 17

    def __init__(self, model: dict):
        self.end = model.get("end_of_word_suffix") or ""
        ids: dict[str, int] = model["vocab"]
        self.size = max(ids.values(), default=0) + 1
        self.rank: dict[int, int] = {}  # of a pair of parts: left * size + right
        self.made: dict[int, tuple[int, int, int]] = {}  # left part, right part and rank of a token
        single = {i for t, i in ids.items() if len(self._bare(t)) == 1}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, made = ids[a], ids[b], ids[a + b]
            self.rank[x * self.size + y] = r
            if made in self.made or any(t not in single and t not in self.made for t in (x, y)):
                raise ValueError(f"merge {r} makes a token again, or of parts not made yet")
            self.made[made] = (x, y, r)
        usable = {t: i for t, i in ids.items() if i in self.made or i in single}
        self.apart: dict[int, bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.goto: list[dict[str, int]] = [{}]
        self.ends: list[tuple[tuple[int, int], ...]] = [()]  # (token, its length) of tokens that end at a state
        self.last: list[tuple[tuple[int, int], ...]] = [()]  # the same for tokens with the end-of-word mark
        marked = {self._bare(t): i for t, i in usable.items() if self.end and t.endswith(self.end)} if self.end else usable
        for table, tokens in ((self.ends, {t: i for t, i in usable.items() if not (self.end and t.endswith(self.end))}), (self.last, marked)):
            for t, i in tokens.items():
                state = 0
                for c in t:
                    to = self.goto[state].get(c)
                    if to is None:
                        to = self.goto[state][c] = len(self.goto)
                        self.goto.append({})
                        self.ends.append(())
                        self.last.append(())
                    state = to
                table[state] = ((i, len(t)),)
        self.fall = [0] * len(self.goto)
        level = list(self.goto[0].values())
        while level:  # shorter tokens that end where a longer one does come after it
            below = []
            for state in level:
                for c, to in self.goto[state].items():
                    back = self.fall[state]
                    while back and c not in self.goto[back]:
                        back = self.fall[back]
                    back = self.fall[to] = self.goto[back].get(c, 0)
                    if self.ends[back]:
                        self.ends[to] = self.ends[to] + self.ends[back] if self.ends[to] else self.ends[back]
                    if self.last[back]:
                        self.last[to] = self.last[to] + self.last[back] if self.last[to] else self.last[back]
                    below.append(to)
            level = below

    def _bare(self, token: str) -> str:
        return token[: -len(self.end)] if self.end and token.endswith(self.end) else token

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts at one side (0 left, 1 right) of a token, smallest first, and the rank at which each is merged away."""
        out = self.spines.get((token, side))
        if out is None:
            out, part, until = [], token, len(self.rank)
            while True:
                out.insert(0, (part, until))
                if part not in self.made:
                    break
                *halves, until = self.made[part]
                part = halves[side]
            self.spines[token, side] = out
        return out

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses the seam while both tokens are put together, lowest rank first and leftmost among equals."""
        never = len(self.rank)
        left, right, i, j = self._spine(a, 1), self._spine(b, 0), 0, 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            t = self.rank.get(x * self.size + y, never)
            if t < x_until and t <= y_until and t < never:
                return False
            if x_until == never == y_until:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _turn(self, state: int, c: str) -> int:
        """The state after ``c``; it is noted, so that the next time is one look-up."""
        at = state
        while at and c not in self.goto[at]:
            at = self.fall[at]
        to = self.goto[at].get(c, 0)
        if to or not state:
            self.goto[state][c] = to
        return to

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Of each distinct word (in byte characters): its ids as little-endian 32-bit integers.

        Sorted words are the leaves of their trie in the order of a walk in depth; where a word leaves the one
        before it, the walk turns back to the node that both pass, and the states of its path are kept. Each
        node has its last token and where that begins, so the ids of a word are read by going back, and the
        time is in proportion to the trie's nodes."""
        words = sorted(set(words))
        if len(self.apart) > self.KNOWN_PAIRS:
            self.apart.clear()
        out: dict[str, bytes] = {}
        goto, ends, last, apart, size, check, turn = self.goto, self.ends, self.last, self.apart, self.size, self._stay_apart, self._turn
        known = apart.get
        token, begin, state = [0], [0], [0]  # of the prefixes on the path, by length
        for word, shared in zip(words, shared_lengths(words), strict=True):
            length = len(word)
            shared = min(shared, length - 1, len(token) - 1)
            del token[shared + 1 :], begin[shared + 1 :], state[shared + 1 :]
            at = state[shared]
            for n in range(shared + 1, length):
                c = word[n - 1]
                to = goto[at].get(c)
                if to is None:
                    to = turn(at, c)
                at = to
                for t, k in ends[at]:
                    s = n - k
                    if s:
                        pair = token[s] * size + t
                        ok = known(pair)
                        if ok is None:
                            ok = apart[pair] = check(token[s], t)
                        if not ok:
                            continue
                    token.append(t)
                    begin.append(s)
                    state.append(at)
                    break
                else:
                    raise ValueError(f"the vocabulary can't spell {word[:n]!r}")
            c = word[-1]
            to = goto[at].get(c)
            if to is None:
                to = turn(at, c)
            for t, k in last[to]:
                s = length - k
                if s:
                    pair = token[s] * size + t
                    ok = known(pair)
                    if ok is None:
                        ok = apart[pair] = check(token[s], t)
                    if not ok:
                        continue
                    ids = [t, token[s]]
                    s = begin[s]
                    while s:
                        ids.append(token[s])
                        s = begin[s]
                    ids.reverse()
                    out[word] = struct.pack(f"<{len(ids)}I", *ids)
                else:
                    out[word] = struct.pack("<I", t)
                break
            else:
                raise ValueError(f"the vocabulary can't spell {word!r}")
        return out


class Decoder:
    """Ids to text as the library's decode(ids, skip_special_tokens=False) gives it where the file names no decoder: tokens joined by spaces."""

    def __init__(self, spec: dict):
        if spec.get("decoder"):
            raise ValueError("the file's own decoder is not known here")
        names = {i: t.encode() for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.token = [names.get(i, b"") for i in range(max(names, default=-1) + 1)]
        self.whole = all(i in names for i in range(len(self.token)))

    def __call__(self, ids: bytes) -> bytes:
        """Text of ids as little-endian 32-bit integers; ids that no token has are left out, as the library does."""
        numbers = np.frombuffer(ids, "<u4")
        if not self.whole or (len(numbers) and int(numbers.max()) >= len(self.token)):
            numbers = numbers[numbers < len(self.token)]
            return b" ".join([t for t in map(self.token.__getitem__, numbers.tolist()) if t])
        return b" ".join(map(self.token.__getitem__, numbers.tolist()))


class Pieces:
    """Splits pieces of text into words of the trie as the tokenizer file says, and puts encodings together."""

    def __init__(self, contents: str):
        from tokenizers import Tokenizer

        spec = json.loads(contents)
        if not word_level(spec):
            raise ValueError("the trie needs a word-level vocabulary with an end-of-word mark")
        self.encoder = TrieEncoder(spec["model"])
        self.library = Tokenizer.from_str(json.dumps({**spec, "model": {**spec["model"], "vocab": {}, "merges": []}}))  # its rules of splitting alone
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.characters = {i: c for i, c in enumerate(byte_characters())}

    def words(self, text: str) -> list[str]:
        if LETTERS.fullmatch(text):
            return [text.lower().encode().decode("latin-1").translate(self.characters)]
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def encode(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each piece."""
        parts: dict[bytes, list[tuple[bool, str]]] = {}
        plain: dict[bytes, str] = {}  # pieces of one word
        for p in pieces:
            text = p.decode()
            if LETTERS.fullmatch(text):
                plain[p] = text.lower() if text.isascii() else self.words(text)[0]
                continue
            at, found = 0, []
            for m in self.specials.finditer(text):
                found += [(False, w) for w in (self.words(text[at : m.start()]) if m.start() > at else ())] + [(True, m[0])]
                at = m.end()
            parts[p] = found + [(False, w) for w in (self.words(text[at:]) if at < len(text) else ())]
        coded = self.encoder.encode([*plain.values(), *(w for x in parts.values() for special, w in x if not special)])
        coded_special = {s: struct.pack("<I", i) for s, i in self.special.items()}
        out = {p: coded[w] for p, w in plain.items()}
        for p, x in parts.items():
            out[p] = b"".join([coded_special[w] if special else coded[w] for special, w in x])
        return out


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens long, ids binary of little-endian unsigned 32-bit integers): see ``encode_decode``."""
    return _coded(docs, path, id_col, text_col, False)


def decode(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded string) of ids as little-endian unsigned 32-bit integers; null ids decode to empty text, and ids that no token has are left out."""
    slim = coded.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{ids_col}`").cast("binary").alias("ids"))
    with open(path, encoding="utf-8") as f:
        given = slim.sparkSession.sparkContext.broadcast(f.read())  # of the size of the file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_text = Decoder(json.loads(given.value))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([to_text(x or b"").decode() for x in part.column(1).to_pylist()], pa.string())], ["doc_id", "decoded"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, decoded string")


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lists: bool = False) -> DataFrame:
    """(doc_id, n_tokens long, ids binary of little-endian unsigned 32-bit integers, decoded string): one row for each row of ``docs``.

    lists: id_list array<int> and the digests ids_sha256 and decoded_sha256 in place of the last two, so that less leaves the workers. ``decoded``: what the ids decode to, special tokens too. Null counts as empty: no tokens, and
    empty ids and decoded text, as for empty and blank texts; repeated rows each get their row; an
    empty table gives an empty result; other columns are not looked at. Time and memory are in proportion to a
    text's length, however long its words are."""
    return _coded(docs, path, id_col, text_col, True, lists)


def _coded(docs: DataFrame, path: str, id_col: str, text_col: str, back: bool, lists: bool = False) -> DataFrame:
    slim = keep_columns(docs, id_col, text_col)
    with open(path, encoding="utf-8") as f:
        given = slim.sparkSession.sparkContext.broadcast(f.read())  # of the size of the file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store()
        key = f"bpe_trie {zlib.crc32(given.value.encode())}"
        if key not in store:
            store[key] = Pieces(given.value), Decoder(json.loads(given.value))
            give_back()
        tool, to_text = store[key]
        words, pieces = Recent(REMEMBERED), Recent(REMEMBERED)  # of this task: a worker that is idle, or does other work, keeps the vocabulary alone
        with no_garbage_collection():
            for b in batches:
                for at, to, data, offs in chunks_of(b.column(1)):
                    raw, ends = data.tobytes(), offs.tolist()
                    rows = [raw[s:e].split() for s, e in zip(ends[:-1], ends[1:], strict=True)]
                    new = words.missing(set().union(*rows))
                    cut = split_words(new)
                    unknown = pieces.missing({p for x in cut for p in x})
                    pieces.learn(tool.encode(unknown))
                    of = pieces.new
                    words.learn({w: of[x[0]] if len(x) == 1 else b"".join([of[p] for p in x]) for w, x in zip(new, cut, strict=True)})
                    known = words.new.__getitem__
                    ids = [b"".join(map(known, x)) for x in rows]
                    made = [b.column(0).slice(at, to - at), pa.array([len(x) // 4 for x in ids], pa.int64())]
                    del rows
                    if lists:
                        made += [pa.array([hashlib.sha256(f(x)).hexdigest() for x in ids], pa.string()) for f in (bytes, to_text)]
                    else:
                        made.append(pa.array(ids, pa.binary()))
                        if back:
                            made.append(pa.array([to_text(x).decode() for x in ids], pa.string()))
                    if lists:
                        whole = pa.array(np.frombuffer(b"".join(ids), np.int32))
                        made.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) // 4 for x in ids)]), pa.int32()), whole))
                    yield pa.RecordBatch.from_arrays(made, names)

    more = {"ids_sha256": "string", "decoded_sha256": "string", "id_list": "array<int>"} if lists else {"ids": "binary"} | ({"decoded": "string"} if back else {})
    columns = {"doc_id": slim.schema["doc_id"].dataType.simpleString(), "n_tokens": "long"} | more
    names = list(columns)
    return slim.mapInArrow(tidied(run), ", ".join(f"{c} {kind}" for c, kind in columns.items()))


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return encode_decode(docs, path, id_col, text_col).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
