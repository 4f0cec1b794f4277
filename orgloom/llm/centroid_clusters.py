"""Exact integer k-means whose distances are screened by the norms of segments.

A vector is scaled and floored to integers, and cut into segments. Stored beside them is its compressed form: of
each segment the sum and the squared norm, which give the part along the segment's mean and the norm of what is
left. By Cauchy-Schwarz, what is left of two segments is no nearer than its norms are apart, so compressed vectors
and centroids bound each distance from below. The centroid of least bound gets its exact
distance first; of the others, only those whose bound isn't over it. All that decides is exact:
bounds are lowered by more than their rounding error, and distances and sums are integers.

How many centroids that rules out is up to the vectors: most of them where vectors lie in groups, few among
vectors without any structure, whose distances to all centroids are nearly alike.

A round is one pass over the stored vectors; its sums are added up in Spark, and a row for each
centroid reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, tidied

WIDTH, SCALE, SEGMENT = 64, 64, 4
#: Vectors of this norm or more after scaling have no place, as squared distances between them need not fit a long.
NORM_LIMIT = 2.0**30
#: Vectors that are screened together.
ROWS = 4096
#: Rounding error of a bound, as a share of the squared norms it comes from: 64 products of doubles stay far below it.
SLACK = 1e-12


def quantized(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", width: int = WIDTH, scale: int = SCALE, segment: int = SEGMENT) -> DataFrame:
    """A written table (vec_id, parts array<int>, sums array<long>, squares array<long>) of the vectors that are kept.

    Kept are vectors of ``width`` components, none null, NaN or infinite, whose norm times ``scale`` is under NORM_LIMIT;
    parts are floor(scale * x); sums and squares are those of each ``segment`` of them. Native."""
    x = F.col("v")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < NORM_LIMIT)
    given = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    whole = given.filter((F.size(x) == width) & F.forall(x, finite))
    scaled = whole.select("vec_id", F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))).alias("p"))
    add = lambda s, v: s + v.cast("double") * v.cast("double")
    near = scaled.filter(F.aggregate("p", F.lit(0.0), add) < NORM_LIMIT * NORM_LIMIT)
    long = F.transform("p", lambda v: v.cast("long"))
    each = lambda f: F.transform(
        F.sequence(F.lit(0), F.lit(width - 1), F.lit(segment)), lambda i: F.aggregate(F.slice(long, i + 1, F.lit(segment)), F.lit(0).cast("long"), f)
    )
    sums, squares = each(lambda s, v: s + v), each(lambda s, v: s + v * v)
    return materialize(near.select("vec_id", F.transform("p", lambda v: v.cast("int")).alias("parts"), sums.alias("sums"), squares.alias("squares")), "quantized")


def compressed(sums: np.ndarray, squares: np.ndarray, segment: int) -> np.ndarray:
    """Of each segment the part along its mean and the norm of the rest, times the root of ``segment``; what is under the root is exact."""
    return np.concatenate([sums.astype(np.float64), np.sqrt((segment * squares - sums * sums).astype(np.float64))], axis=1)


def screen(parts: np.ndarray, sums: np.ndarray, squares: np.ndarray, centroids: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance, number of exact distances) of each vector; ties go to the smaller number."""
    n, k = len(parts), len(centroids)
    blocks = centroids.reshape(k, -1, segment)
    own = (blocks * blocks).sum(axis=2)
    norms = squares.sum(axis=1)[:, None].astype(np.float64) + own.sum(axis=1)[None, :].astype(np.float64)
    bound = norms * (1 - SLACK) - 2 / segment * (compressed(sums, squares, segment) @ compressed(blocks.sum(axis=2), own, segment).T)
    rows = np.arange(n)
    found = np.argmin(bound, axis=1)
    step = parts - centroids[found]
    best = np.einsum("ij,ij->i", step, step)
    open_ = bound <= best[:, None]
    open_[rows, found] = False
    for c in range(k):
        near = rows[open_[:, c] & (bound[:, c] <= best)]  # best has got less meanwhile
        step = parts[near] - centroids[c]
        d = np.einsum("ij,ij->i", step, step)
        open_[:, c] = False
        open_[near, c] = True
        win = (d < best[near]) | ((d == best[near]) & (c < found[near]))
        best[near[win]], found[near[win]] = d[win], c
    return found, best, 1 + open_.sum(axis=1)


def _pass(table: DataFrame, columns: list[str], work: Callable, schema: str) -> DataFrame:
    """``work`` over blocks (rows, parts, sums, squares) of the stored table; at the end of a task it is called with None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for b in batches:
            for at in range(0, len(b), ROWS):
                piece = b.slice(at, ROWS)
                yield from work(state, piece, *(np.asarray(piece.column(i).flatten()).reshape(len(piece), -1).astype(np.int64) for i in range(3)))
        yield from work(state, None, None, None, None)

    return table.select("parts", "sums", "squares", *columns).mapInArrow(tidied(run), schema)


def _moved(table: DataFrame, centroids: np.ndarray, segment: int) -> np.ndarray:
    """The next centroids: exact floors of the means; empty ones stay."""
    width = centroids.shape[1]

    def work(state: dict, piece: pa.RecordBatch | None, parts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Iterator[pa.RecordBatch]:
        if piece is not None:
            found = screen(parts, sums, squares, centroids, segment)[0]
            for c in np.unique(found).tolist():
                own = parts[found == c]
                total, n = state.get(c, (0, 0))
                state[c] = (total + own.sum(axis=0), n + len(own))
        elif state:
            keys = sorted(state)
            added = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * width, pa.array(np.concatenate([state[c][0] for c in keys]), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([state[c][1] for c in keys], pa.int64()), added], ["cluster", "n", "sums"])

    partial = _pass(table, [], work, "cluster int, n long, sums array<long>")
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    out = centroids.copy()
    for r in partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[exact(F.col("sums")[i]) for i in range(width)]).alias("sums")).collect():
        out[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
    return out


def starting(table: DataFrame, k: int, seed: Column) -> np.ndarray:
    """The ``k`` vectors of least ``seed``, in its order (fewer, if the table has fewer)."""
    rows = table.select(seed.alias("seed"), "parts").orderBy(F.col("seed").asc_nulls_last(), "parts").limit(k).collect()
    return np.array([r["parts"] for r in rows], np.int64)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, id_col: str = "vec_id", vec_col: str = "embedding", width: int = WIDTH, scale: int = SCALE, segment: int = SEGMENT) -> tuple[DataFrame, np.ndarray]:
    """(DataFrame (vec_id, cluster int, distance long, n_exact int), final centroids): one row for each vector that ``quantized`` keeps.

    The first centroids are the ``k`` vectors of least sha256 of ``1:<vec_id>``, as hexadecimal digits; ids that repeat are in order
    of their vectors, and a null id comes last. Repeated rows are vectors of their own; ties go to the smaller centroid; an
    empty table, or one without a vector that is kept, gives an empty result; other columns are not looked at.
    n_exact counts the centroids whose distance was not ruled out by a bound."""
    if width % segment or segment > 8:  # eight squares below the limit still fit a long
        raise ValueError("segments of at most 8 components must divide the vector")
    table = quantized(vectors, id_col, vec_col, width, scale, segment)
    kind = table.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long, n_exact int"
    centroids = starting(table, k, F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))
    if not len(centroids):
        return table.sparkSession.createDataFrame([], schema), np.zeros((0, width), np.int64)
    for _ in range(rounds):
        centroids = _moved(table, centroids, segment)

    def work(state: dict, piece: pa.RecordBatch | None, parts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Iterator[pa.RecordBatch]:
        if piece is not None:
            found, best, exact = screen(parts, sums, squares, centroids, segment)
            yield pa.RecordBatch.from_arrays([piece.column(3), pa.array(found, pa.int32()), pa.array(best, pa.int64()), pa.array(exact, pa.int32())], ["vec_id", "cluster", "distance", "n_exact"])

    return materialize(_pass(table, ["vec_id"], work, schema), "clusters"), centroids


def centroid_sha256(centroids: np.ndarray) -> list[str]:
    """Of each centroid's components, as decimal integers joined by commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia and inertia (long; null if they don't fit one) and centroid_sha256; a row for each centroid goes by the driver."""
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(total.alias("s")).collect()}
    fits = lambda x: F.lit(x if x < 1 << 63 else None).cast("long")
    pick = lambda values, kind: F.element_at(F.array(*values) if values else F.array().cast(f"array<{kind}>"), F.col("cluster") + 1)
    (sha,) = fresh(assigned, "centroid_sha256")
    return assigned.select(
        "*",
        pick([fits(sums.get(c, 0)) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        fits(sum(sums.values())).alias("inertia"),
        pick([F.lit(h) for h in centroid_sha256(centroids)], "string").alias(sha),
    )
