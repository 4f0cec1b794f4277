"""Boundaries at which a text may be cut without changing how the tokenizer encodes it.

For a tokenizer that drops white space, encodes runs of letters, single digits and
runs of other signs each on its own, and lower-cases character by character, every
ASCII space is such a boundary. So is the seam between ASCII punctuation and a letter
or digit next to it, if that character neither composes with its neighbour nor changes
its class in lower case.
"""

from __future__ import annotations

import contextlib
import gc
import re
from collections.abc import Iterator

#: ASCII punctuation but the apostrophe, which begins contractions.
PUNCTUATION = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
#: Letters that neither compose nor change their number in lower case.
LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-įı-ňŊ-ſ]+")
_ALNUM = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Two-byte characters of U+00C0 to U+017F that are no letters or grow in lower case.
_ODD = frozenset({b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0"})


def _seam(pair: bytes, ascii_byte: int) -> bool:
    return ascii_byte in _ALNUM or (len(pair) == 2 and 0xC3 <= pair[0] <= 0xC5 and 0x80 <= pair[1] <= 0xBF and pair not in _ODD)


def split_word(word: bytes, special: bytes = b"<|") -> tuple[bytes, ...]:
    """The pieces of a word without ASCII spaces; the word itself where no cut is safe."""
    if special in word:
        return (word,)
    core = word.strip(PUNCTUATION)
    if not core:
        return (word,)
    if not (_seam(core[:2], core[0]) and _seam(core[-2:], core[-1])):
        return (word.lower(),)
    core_lower = core.lower()
    if len(core) == len(word):
        return (core_lower,)
    at = word.index(core)
    return tuple(x for x in (word[:at], core_lower, word[at + len(core) :]) if x)


def word_level(spec: dict) -> bool:
    """Whether a tokenizer file meets the conditions above: NFC, white space and lower case in its normalizer, white space dropped by its splitter, and an end-of-word mark."""
    norm = spec.get("normalizer") or {}
    kinds = {n["type"] for n in norm.get("normalizers", [norm] if norm else [])}
    pre = spec.get("pre_tokenizer") or {}
    splits = [x for x in pre.get("pretokenizers", [pre] if pre else []) if x["type"] == "Split"]
    drops = len(splits) == 1 and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and r"[^\s\p{L}\p{N}]+" in splits[0]["pattern"].get("Regex", "")
    return "Lowercase" in kinds and kinds <= {"NFC", "Replace", "Lowercase"} and bool(drops) and bool(spec["model"].get("end_of_word_suffix"))


_BEFORE_SPACE = re.compile(rb"(?<=[a-zA-Z])(?= [a-zA-Z])")


def byte_level(spec: dict) -> bool:
    """Whether a byte-level tokenizer splits by its usual pattern, so that a space between two ASCII letters begins a word."""
    pre = spec.get("pre_tokenizer") or {}
    return pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")


def cut_long(text: bytes, size: int) -> list[bytes]:
    """Parts of about ``size`` bytes, cut before spaces between ASCII letters; longer where there are none."""
    out, at = [], 0
    while len(text) - at > size:
        m = _BEFORE_SPACE.search(text, at + size)
        if not m:
            break
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]]


class Recent:
    """A memory of values by key, bounded in bytes, in two generations: what is asked for moves to the newer one.

    Long keys (over a 256th of the bound) are only kept until the next call."""

    #: About what the objects of an entry take besides their bytes.
    ENTRY = 180

    def __init__(self, bound: int):
        self.bound, self.new, self.old, self.held, self.large = bound, {}, {}, 0, []

    def missing(self, keys) -> list:
        """The keys that are not known; all others can be read from ``new`` until the next call."""
        for k in self.large:
            self.new.pop(k, None)
        self.large = []
        if self.held > self.bound:
            self.old, self.new, self.held = self.new, {}, 0
        new, old, out = self.new, self.old, []
        if not old:
            return [k for k in keys if k not in new]
        before = len(new)
        for k in keys:
            if k not in new:
                v = old.get(k)
                if v is None:
                    out.append(k)
                else:
                    new[k] = v
        self.held += (len(new) - before) * self.ENTRY
        return out

    def learn(self, found: dict[bytes, bytes | int]) -> None:
        self.new.update(found)
        self.held += len(found) * self.ENTRY
        if sum(map(len, found)) > self.bound >> 6:  # else no long ones are among them
            self.large = [k for k in found if len(k) > self.bound >> 8]


@contextlib.contextmanager
def no_garbage_collection() -> Iterator[None]:
    """For millions of small objects, and no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker, across tasks; only ever a memory of what can be made again."""
    import sys
    import types

    return sys.modules.setdefault("orgloom_worker_store", types.ModuleType("orgloom_worker_store")).__dict__


def split_words(words: list[bytes]) -> list[tuple[bytes, ...]]:
    return [(w.lower(),) if w.isalpha() else split_word(w) for w in words]
