"""Languages of texts by a convolutional network over bytes.

A text is cut into windows of WINDOW bytes, all of it. Of each window, bytes become vectors; filters of several widths go over
them; the largest value of each filter in the window is kept; and a softmax gives the languages' probabilities. A text's are the
mean of its windows', by their bytes. The network is fitted in numpy on a bounded sample of labelled texts; scoring goes over
all windows of all texts, in place, as batches of one matrix product each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks_of, keep_columns, tidied

WINDOW = 128
#: Filters of each width in bytes, and numbers of a byte's vector.
WIDTHS, FILTERS, VECTOR = (2, 3, 4), 16, 8
#: Labelled texts that the network is fitted on, at most, of each language; windows of each, evenly spaced; the most frequent languages.
TRAIN_TEXTS, TRAIN_WINDOWS, LANGUAGES = 500, 6, 256
UNKNOWN = "und"
#: Windows of a matrix product.
BATCH = 256
_LETTER = r"\p{L}"


def windows_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(uint8 windows, filled up with zeros; bytes of each; each row's first window and the number of all). Every row has one at least."""
    size = np.diff(offs)
    n = np.maximum(1, -(-size // WINDOW))
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
    row = np.repeat(np.arange(len(size)), n)
    start = offs[row] + (np.arange(at[-1]) - at[row]) * WINDOW
    length = np.minimum(WINDOW, offs[row + 1] - start)
    out = np.zeros((int(at[-1]), WINDOW), np.uint8)
    where = np.arange(WINDOW) < length[:, None]
    out[where] = data  # windows in order are the bytes in order
    return out, length, at


class ByteConvolution:
    """Byte vectors, filters of several widths, max pooling, softmax."""

    def __init__(self, names: list[str], seed: int = 1):
        r = np.random.default_rng(seed)
        k, span = len(WIDTHS) * FILTERS, max(WIDTHS) * VECTOR
        self.names = names
        mask = np.zeros((span, k), np.float32)
        for i, w in enumerate(WIDTHS):  # one matrix for all widths; shorter filters have nothing beyond theirs
            mask[: w * VECTOR, i * FILTERS : (i + 1) * FILTERS] = 1
        self.mask = mask
        self.p = {
            "E": r.normal(0, 1, (256, VECTOR)).astype(np.float32), "W": (r.normal(0, 1, (span, k)) / np.sqrt(np.maximum(mask.sum(axis=0), 1))).astype(np.float32) * mask, "b": np.zeros(k, np.float32),
            "O": r.normal(0, 1 / np.sqrt(k), (k, len(names))).astype(np.float32), "o": np.zeros(len(names), np.float32),
        }
        self.p["E"][0] = 0

    def _unfolded(self, x: np.ndarray) -> np.ndarray:
        """The vectors of max(WIDTHS) bytes from each place on; behind the window there are zeros."""
        n, last = len(x), max(WIDTHS) - 1
        v = np.zeros((n, WINDOW + last, VECTOR), np.float32)
        v[:, :WINDOW] = self.p["E"][x]
        s = v.strides
        return np.ascontiguousarray(np.lib.stride_tricks.as_strided(v, (n, WINDOW, (last + 1) * VECTOR), (s[0], s[1], s[2]))).reshape(n * WINDOW, -1)

    def _forward(self, x: np.ndarray, back: bool = False) -> tuple:
        u = self._unfolded(x)
        z = (u @ self.p["W"]).reshape(len(x), WINDOW, -1)
        at = z.argmax(axis=1) if back else None
        top = np.take_along_axis(z, at[:, None], 1)[:, 0] if back else z.max(axis=1)
        h = np.maximum(top + self.p["b"], 0)  # a bias and a ramp don't change which place is largest
        logit = h @ self.p["O"] + self.p["o"]
        logit -= logit.max(axis=1, keepdims=True)
        e = np.exp(logit)
        return u, at, h, e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + BATCH])[-1] for i in range(0, len(x), BATCH)])

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of windows ``x`` of languages ``y``."""
        p, n, k = self.p, len(x), self.p["W"].shape[1]
        u, at, h, q = self._forward(x, True)
        d = q.copy()
        d[np.arange(n), y] -= 1
        d /= n
        dh = (d @ p["O"].T) * (h > 0)
        place = np.arange(n)[:, None] * WINDOW + at  # of each window and filter
        seen = u[place.ravel()].reshape(n, k, -1)
        dw = np.einsum("nk,nks->sk", dh, seen) * self.mask
        du = (dh[:, :, None] * p["W"].T[None]).reshape(n, k, -1, VECTOR)
        byte = np.zeros((n, WINDOW + max(WIDTHS) - 1), np.int64)
        byte[:, :WINDOW] = x
        which = byte[np.arange(n)[:, None, None], at[:, :, None] + np.arange(max(WIDTHS))]
        de = np.stack([np.bincount(which.ravel(), weights=du[..., i].ravel(), minlength=256) for i in range(VECTOR)], axis=1)
        de[0] = 0
        return {"E": de, "W": dw, "b": dh.sum(axis=0), "O": h.T @ d, "o": d.sum(axis=0)}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, rate: float = 0.01, seed: int = 2) -> None:
        """Adam over shuffled batches; the rate falls to nothing. Rare languages come as often as common ones."""
        r = np.random.default_rng(seed)
        m, s = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        share = 1 / np.maximum(np.bincount(y, minlength=len(self.names)), 1)[y]
        share /= share.sum()
        steps = max(1, epochs * -(-len(x) // BATCH))
        for step in range(1, steps + 1):
            i = r.choice(len(x), BATCH, p=share)
            now = rate * (1 - (step - 1) / steps)
            for k, g in self.gradient(x[i], y[i]).items():
                m[k] = (0.9 * m[k] + 0.1 * g).astype(np.float32)
                s[k] = (0.99 * s[k] + 0.01 * g * g).astype(np.float32)
                self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", train_texts: int = TRAIN_TEXTS, train_windows: int = TRAIN_WINDOWS, languages: int = LANGUAGES) -> ByteConvolution | None:
    """A network of the labelled texts outside the held-out rows (null if there are none).

    Of each of the ``languages`` most frequent labels, about ``train_texts`` ids of least hash are taken, and 1.5 times as many in all at most;
    rows of a null id or label, and texts without a letter, teach nothing; of rows that repeat an id, one of least window."""
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known = slim.filter("doc_id IS NOT NULL AND lang IS NOT NULL").filter(~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return None
    names = sorted(r["lang"] for r in counts)
    keep = F.lit(-1.0)
    for r in counts:  # a share of ids of each language
        keep = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, train_texts / r["count"]))).otherwise(keep)
    place = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(place < keep).filter(F.col("text").rlike(_LETTER)).select("text", F.array_position(F.array(*[F.lit(x) for x in names]), F.col("lang")).cast("int").alias("y"), F.xxhash64("doc_id").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, data, offs in chunks_of(b.column(0)):
                x, _, first = windows_of(data, offs)
                out = [x[s:e] if e - s <= train_windows else x[np.linspace(s, e - 1, train_windows).astype(np.int64)] for s, e in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(2).slice(at, to - at), b.column(1).slice(at, to - at), pa.array([w.tobytes() for w in out], pa.binary())], ["h", "y", "x"])

    found = sample.mapInArrow(tidied(run), "h long, y int, x binary").groupBy("h").agg(F.min(F.struct("y", "x")).alias("r"))
    rows = found.orderBy("h").limit(train_texts * len(names) * 3 // 2).select("r.*").collect()
    if not rows:
        return None
    bags = [np.frombuffer(r["x"], np.uint8).reshape(-1, WINDOW) for r in rows]
    model = ByteConvolution(names)
    model.fit(np.concatenate(bags), np.repeat([r["y"] - 1 for r in rows], [len(x) for x in bags]).astype(np.int64))
    return model


def predict(docs: DataFrame, model: ByteConvolution | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out boolean, lang_pred string, score double, n_windows long): one row for each row of ``docs``.

    lang_pred is the language of the largest mean probability (ties: the least name) and score that mean. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if nothing was learned. Repeated rows get the same result; an empty table gives an
    empty one; other columns are not looked at."""
    slim = keep_columns(docs, id_col, text_col).withColumn("letters", F.coalesce(F.col("text").rlike(_LETTER), F.lit(False)))
    kind = slim.schema["doc_id"].dataType.simpleString()
    given = slim.sparkSession.sparkContext.broadcast((model.names, model.p) if model else None)  # some thousand numbers, and a few for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = None
        if given.value:
            net = ByteConvolution(given.value[0])
            net.p = given.value[1]
        for b in batches:
            for at, to, data, offs in chunks_of(b.column(1), 1 << 20):
                if net:
                    x, size, first = windows_of(data, offs)
                    weight = np.maximum(size, 1).astype(np.float64)
                    total = np.add.reduceat(net.probabilities(x) * weight[:, None], first[:-1], axis=0)
                    mean = total / np.add.reduceat(weight, first[:-1])[:, None]
                    best, n = mean.argmax(axis=1), np.diff(first)
                    name = np.array(net.names, object)[best]
                    score = np.clip(mean[np.arange(len(best)), best], 0, 1)
                else:
                    name, score, n = np.full(to - at, UNKNOWN, object), np.zeros(to - at), np.zeros(to - at, np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, to - at), pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64()), b.column(2).slice(at, to - at)], ["doc_id", "name", "score", "n_windows", "letters"])

    found = slim.mapInArrow(tidied(run), f"doc_id {kind}, name string, score double, n_windows long, letters boolean")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.when(F.col("letters"), F.col("name")).otherwise(UNKNOWN).alias("lang_pred"), F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"), "n_windows")
