"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. An encoder turns each passage's features
(shape of its words and signs, repetition, hashed words) into a vector; gated attention,
learned from document labels alone, weighs the passages; and the weighted vector is scored. Fitting
takes a bounded sample of labelled rows; scoring goes over all passages of all documents, in place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WordHasher, chunks_of, keep_columns, tidied, word_spans

PASSAGE = 64
#: Labelled documents that the model is fitted on, at most, and passages of each, evenly spaced.
TRAIN_DOCS, TRAIN_PASSAGES = 3000, 48
BUCKETS = 24
LAGS = (1, 2, 3, 4, 6, 8)
_hash = WordHasher(77, lower=True)


def _classes() -> np.ndarray:
    """Byte classes: lower, upper, digit, sentence marks, other signs, non-ASCII."""
    table = np.zeros((6, 256), np.int64)
    table[0, 97:123] = table[1, 65:91] = table[2, 48:58] = table[5, 128:] = 1
    table[3, np.frombuffer(b".,;:?'\"()-", np.uint8)] = 1
    table[4, 33:127] = 1 - table[:4, 33:127].sum(axis=0)
    return table


CLASSES = _classes()
N_FEATURES = 6 + 9 + len(LAGS) + 2 + BUCKETS


def passage_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(float32 features of each passage, index of each document's first passage and the number of all). No document is without a passage."""
    st, en, first = word_spans(data, offs, SPACE)
    n_words = np.diff(first)
    n_passages = np.maximum(1, -(-n_words // PASSAGE))
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(n_passages)])
    out = np.zeros((int(at[-1]), N_FEATURES), np.float32)
    if not len(st):
        return out, at
    doc = np.repeat(np.arange(len(n_words)), n_words)
    within = np.arange(len(st)) - first[doc]
    passage = at[doc] + within // PASSAGE
    size = (en - st).astype(np.float64)
    total = lambda x: np.bincount(passage, weights=x, minlength=len(out))
    words = np.maximum(total(np.ones(len(st))), 1)
    letters = np.maximum(total(size), 1)
    for i, table in enumerate(CLASSES):
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(table[data])])
        count = sums[en] - sums[st]
        out[:, i] = total(count) / letters
        if i == 1:
            out[:, 6] = total(count == size) / words
        elif i == 4:
            out[:, 7] = total(count == size) / words
            out[:, 8] = total(count > 1) / words
    last = data[en - 1]
    out[:, 9] = total(CLASSES[4][last] > 0) / words
    out[:, 10] = total(CLASSES[3][last] > 0) / words
    out[:, 11] = np.log(words) / np.log(PASSAGE)
    out[:, 12] = total(size) / words / 8
    out[:, 13] = np.sqrt(np.maximum(total(size * size) / words - (total(size) / words) ** 2, 0)) / 4
    lines = np.concatenate([np.zeros(1, np.int64), np.cumsum(data == 10)])
    out[:, 14] = total(lines[st] - lines[np.concatenate([np.zeros(1, np.int64), en[:-1]])]) / words
    h = _hash(data, st, en)
    for i, lag in enumerate(LAGS):
        same = np.zeros(len(h))
        same[lag:] = (h[lag:] == h[:-lag]) & (doc[lag:] == doc[:-lag])
        out[:, 15 + i] = total(same) / words
    four = h.copy()
    for lag in (1, 2, 3):  # four words in a row that come again in the document
        four[:-lag] += h[lag:] * np.uint64(2 * lag + 1)
    four ^= doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(four)
    equal = four[order][1:] == four[order][:-1]
    again = np.zeros(len(h), bool)
    again[order[1:]] |= equal
    again[order[:-1]] |= equal
    out[:, 15 + len(LAGS)] = total(again & (within < n_words[doc] - 3)) / words
    out[:, 16 + len(LAGS)] = np.log1p(n_words[np.repeat(np.arange(len(n_words)), n_passages)]) / 10
    sign = 1.0 - 2.0 * ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    bag = np.bincount(passage * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), weights=sign, minlength=len(out) * BUCKETS)
    out[:, -BUCKETS:] = bag.reshape(-1, BUCKETS) / np.sqrt(words)[:, None]
    return out, at


class GatedAttention:
    """tanh encoder, gated attention over the passages of a bag, logistic score."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 1):
        r = np.random.default_rng(seed)
        init = lambda a, b: r.normal(0, 1 / np.sqrt(a), (a, b))
        self.p = {"E": init(N_FEATURES, hidden), "e": np.zeros(hidden), "V": init(hidden, gate), "U": init(hidden, gate), "w": init(gate, 1), "c": init(hidden, 1), "b": np.zeros(1)}
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)

    def _forward(self, x: np.ndarray, at: np.ndarray) -> tuple:
        p = self.p
        h = np.tanh(x @ p["E"] + p["e"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        logit = ((v * u) @ p["w"])[:, 0]
        bag = np.repeat(np.arange(len(at) - 1), np.diff(at))
        a = np.exp(logit - np.maximum.reduceat(logit, at[:-1])[bag])
        a /= np.add.reduceat(a, at[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, at[:-1], axis=0)
        return h, v, u, a, bag, z, 1 / (1 + np.exp(-np.clip((z @ p["c"])[:, 0] + p["b"], -40, 40)))

    def fit(self, x: np.ndarray, at: np.ndarray, y: np.ndarray, epochs: int = 200, rate: float = 0.02, decay: float = 1e-4) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        m = {k: np.zeros_like(q) for k, q in self.p.items()}
        s = {k: np.zeros_like(q) for k, q in self.p.items()}
        for step in range(1, epochs + 1):
            p = self.p
            h, v, u, a, bag, z, score = self._forward(x, at)
            d = ((score - y) / len(y))[:, None]
            dz = d @ p["c"].T
            dh = a[:, None] * dz[bag]
            da = (h * dz[bag]).sum(axis=1)
            dl = a * (da - np.add.reduceat(a * da, at[:-1])[bag])
            dvu = dl[:, None] * p["w"].T
            dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
            dh += dv @ p["V"].T + du @ p["U"].T
            de = dh * (1 - h * h)
            grad = {"E": x.T @ de, "e": de.sum(axis=0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ dl[:, None], "c": z.T @ d, "b": d.sum(axis=0)}
            for k, g in grad.items():
                g = g + decay * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)

    def plain(self) -> dict[str, np.ndarray]:
        return {**self.p, "mean": self.mean, "scale": self.scale}

    @classmethod
    def of(cls, numbers: dict[str, np.ndarray]) -> GatedAttention:
        out = cls()
        out.p = {k: v for k, v in numbers.items() if k not in ("mean", "scale")}
        out.mean, out.scale = numbers["mean"], numbers["scale"]
        return out

    def score(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._forward(np.clip((x - self.mean) / self.scale, -8, 8), at)[-1]


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS, train_passages: int = TRAIN_PASSAGES) -> GatedAttention | float:
    """A model of ``labels`` outside the held-out rows, or the only label there is (0.5 if none).

    It is fitted on ``train_docs`` labels of least hash, and on twice as many documents at most, if ids repeat, again those of least hash."""
    marked = labels.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{label_col}`").cast("double").alias("y"))
    marked = marked.filter("label_id IS NOT NULL AND y IS NOT NULL").filter(~held_out(F.col("label_id")))
    sample = marked.orderBy(F.xxhash64("label_id"), "label_id", "y").limit(train_docs)  # bounded, so it may be broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, data, offs in chunks_of(b.column(0)):
                x, first = passage_features(data, offs)
                bags = [x[s:e] if e - s <= train_passages else x[np.linspace(s, e - 1, train_passages).astype(np.int64)] for s, e in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(2).slice(at, to - at), b.column(1).slice(at, to - at), pa.array([v.tobytes() for v in bags], pa.binary())], ["h", "y", "x"])

    slim = keep_columns(docs, id_col, text_col)
    joined = slim.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("text", "y", F.xxhash64("doc_id", "text").alias("h"))
    rows = joined.mapInArrow(tidied(run), "h long, y double, x binary").orderBy("h", "y").limit(2 * train_docs).collect()  # ids may repeat
    rows.sort(key=lambda r: (r["y"], bytes(r["x"])))
    y = np.array([r["y"] for r in rows])
    if len(set(y.tolist())) < 2:
        return float(y[0]) if len(y) else 0.5
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES).astype(np.float64) for r in rows]
    model = GatedAttention()
    model.fit(np.concatenate(bags), np.concatenate([[0], np.cumsum([len(x) for x in bags])]).astype(np.int64), y)
    return model


def score(docs: DataFrame, model: GatedAttention | float, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.3) -> DataFrame:
    """(doc_id, held_out boolean, score double, predicted int, n_passages long): one row for each row of ``docs``.

    Null, empty and blank texts are a bag of one passage without words, and scored like any other;
    repeated rows get the same score; an empty table gives an empty result; other columns are not looked at."""
    slim = keep_columns(docs, id_col, text_col)
    given = slim.sparkSession.sparkContext.broadcast(model if isinstance(model, float) else model.plain())  # a few thousand numbers; no class, which executors need not have

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = given.value if isinstance(given.value, float) else GatedAttention.of(given.value)
        for b in batches:
            for at, to, data, offs in chunks_of(b.column(1)):
                x, first = passage_features(data, offs)
                s = np.full(to - at, model) if isinstance(model, float) else model.score(x, first)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, to - at), pa.array(s, pa.float64()), pa.array(np.diff(first), pa.int64())], ["doc_id", "score", "n_passages"])

    scored = slim.mapInArrow(tidied(run), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double, n_passages long")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"), "n_passages")
