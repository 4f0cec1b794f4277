"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two 32-bit segments. Two fingerprints that differ in
three bits or fewer differ in at most one bit of one segment, so a table of
exact segments, met by the members of each segment's Hamming ball of radius one,
finds every such pair; the complete distance is then verified. Of two segments one bit
apart one has an even number of bits, so only those are sent with their ball. Copies of a
fingerprint are one row, so a group of identical texts costs one row whatever its size, and where
many fingerprints meet, only links that span them are given: one less than there are, at most.

Similar texts, well beyond three bits, meet by the first of their shingles, which loses none of them; what
meets, and is near enough by a wider fingerprint, is a candidate, and the Jaccard index of the texts' shingles is then counted among candidates.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, chunks_of, fresh, is_marked, keep_columns, materialize, mix, owned, release, stage, tidied

SEED = 42
_U = np.uint64
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANE = (np.arange(8) * 256)[None, :]
#: Rows of a batch of fingerprints that is dealt out at once.
DEAL_ROWS = 1 << 12


def shingle_hashes(text: bytes | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of a text's words, A-Z lower-cased, repeats included; of fewer words: of all; of none: empty."""
    words = (text or b"").lower().split()  # of bytes: lower() is A-Z alone, split() the six ASCII spaces
    n = len(words)
    if not n:
        return np.zeros(0, _U)
    joined = b" ".join(words)
    if n <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], _U)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])[: n - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], _U)


def _set_bits(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    return (np.bincount((h.view(np.uint8).reshape(-1, 8) + _LANE).ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()


def fingerprint(text: str | bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text; of no words: 0. Null counts as empty."""
    h = shingle_hashes(text.encode() if isinstance(text, str) else text, shingle)
    return int(np.packbits(2 * _set_bits(h) > len(h), bitorder="little").view("<u8")[0]) if len(h) else 0


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, row after the last, texts) of pieces of bounded bytes; null is empty."""
    for at, to, data, offs in chunks_of(column):
        raw, ends = data.tobytes(), offs.tolist()
        yield at, to, [raw[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp long): one row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, texts in _texts(b.column(1)):
                fp = np.array([fingerprint(t, shingle) for t in texts], _U).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, to - at), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    slim = keep_columns(docs, id_col, text_col)
    return slim.mapInArrow(tidied(run), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp long")


# --------------------------------------------------------------------------
# Keys that meet: dealt out in packed bytes, so that a row is a part of a batch and not a key

def deal_out(keys: np.ndarray, parts: int, *columns: np.ndarray) -> pa.RecordBatch:
    """(part, keys, further columns) in bytes: the keys of each part, and what belongs to them; a part is a hash of the key."""
    part = (mix(keys.astype(_U)) % _U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
    own = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
    blobs = [pa.array([x[cuts[p] : cuts[p + 1]].tobytes() for p in own], pa.binary()) for x in (c[order] for c in (keys, *columns))]
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *blobs], ["part", "keys", *[f"c{i}" for i in range(len(columns))]])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list[bytes]]]:
    """The columns of bytes of each part, of rows in order of their part."""
    at, columns = None, []
    for b in batches:
        part, *rest = (c.to_pylist() for c in b.columns)
        for i, p in enumerate(part):
            if p != at:
                if columns:
                    yield columns
                at, columns = p, [[] for _ in rest]
            for c, r in zip(columns, rest, strict=True):
                c.append(r[i])
    if columns:
        yield columns


#: Bytes of keys and owners of a part, about; a task holds one part at a time.
PART_BYTES = 64 << 20


def spread_of(spark: SparkSession, size: int) -> int:
    """Parts that ``size`` bytes of keys are dealt to: as many as there are PART_BYTES, and no fewer than two for each partition of a shuffle, so that those are about equal."""
    return 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (2 * PART_BYTES)))


#: Fingerprints from which on near ones are looked up by blocks of their bits, where distances are small.
MANY, SMALL_DISTANCE = 1024, 7


def near_spanning(nodes: np.ndarray, prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected among some fingerprints (rows of 64-bit numbers).

    Of many, those bits that vary at all are cut into one block more than may differ: near ones agree in one of the blocks, so only those meet, and so on within
    them. The links of few are at most one less than there are."""
    if len(nodes) > MANY and distance <= SMALL_DISTANCE:
        bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1)
        varying = np.flatnonzero((bits != bits[0]).any(axis=0))
        if len(varying) > distance:
            found: set[tuple[int, int]] = set()
            for cut in np.array_split(varying, distance + 1):
                block = bits[:, cut].astype(np.int64) @ (np.int64(1) << np.arange(len(cut), dtype=np.int64)) if len(cut) < 63 else np.unique(bits[:, cut], axis=0, return_inverse=True)[1].ravel()
                order = np.argsort(block, kind="stable")
                for same in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                    if len(same) > 1:
                        found.update(near_spanning(nodes[same], prints[same], distance))
            return list(found)
    out, left = [], np.arange(len(nodes))
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]).sum(axis=1) <= distance
            out += [(int(nodes[at]), int(nodes[x])) for x in left[near]]
            front += left[near].tolist()
            left = left[~near]
    return out


def met_links(keys: np.ndarray, nodes: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that span what is near among the nodes of each key; ``keys`` are sorted."""
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(cuts, len(keys)))
    two = cuts[size == 2]
    two = two[(np.bitwise_count(prints[two] ^ prints[two + 1]).sum(axis=1) <= distance) & (nodes[two] != nodes[two + 1])]
    found: list[tuple[int, int]] = []
    for s, n in zip(cuts[size > 2].tolist(), size[size > 2].tolist(), strict=True):
        found += near_spanning(nodes[s : s + n], prints[s : s + n], distance)
    more = np.array(found, np.int64).reshape(-1, 2)
    return np.concatenate([nodes[two], more[:, 0]]), np.concatenate([nodes[two + 1], more[:, 1]])


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b): links between different values of ``fps.fp`` at most ``distance`` (0 to 3) bits apart, which connect whatever such links connect."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments with balls of radius one reach three bits")
    parts = spread_of(fps.sparkSession, fps.count() * 2 * 17 * 16)  # a segment's ball has 1 or 33 keys
    flips = _U(1) << np.arange(32, dtype=_U)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = np.asarray(b.column(0), np.int64).view(_U)
            for i in range(0, len(every), DEAL_ROWS):
                fp = every[i : i + DEAL_ROWS]
                keys, owners = [], []
                for s in range(2):
                    own = (fp >> _U(32 * s)) & _U(0xFFFFFFFF)
                    even = np.flatnonzero(np.bitwise_count(own) % 2 == 0)
                    ball = own[even, None] ^ flips
                    keys += [own | _U(s << 32), (ball | _U(s << 32)).ravel()]
                    owners += [fp, np.repeat(fp[even], 32)]
                yield deal_out(np.concatenate(keys), parts, np.concatenate(owners))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, owners in gathered(batches):
            k, f = (np.frombuffer(b"".join(x), np.uint64) for x in (keys, owners))
            order = np.argsort(k, kind="stable")
            a, b = met_links(k[order], f[order].view(np.int64), f[order][:, None], distance)
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi)], ["a", "b"])

    dealt = fps.select("fp").mapInArrow(tidied(deal), "part int, keys binary, c0 binary")
    return dealt.repartition(parts // 2, "part").sortWithinPartitions("part").mapInArrow(tidied(meet), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that links reach, for each node of ``edges`` (a, b).

    Each node points to its least neighbour if that is less; pointers are followed to their ends; links
    are drawn between the ends, those within one are dropped, and what is left is done again. Links shrink
    from round to round, each step ends in a written table, and no link leaves the executors. Plans read those tables and nothing before them, so the
    driver's plans don't grow; pointers of a round are deleted with it."""
    spark = edges.sparkSession
    left, found = materialize(edges.select("a", "b").distinct(), "links"), None
    while True:
        pointers = f"pointers-{uuid.uuid4().hex}"
        both = left.union(left.select("b", "a"))
        with owned(pointers):
            point = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "pointers")
            moved = True
            while moved:
                far = point.select(F.col("node").alias("via"), F.col("root").alias("end"))
                jumped = materialize(point.join(far, F.col("root") == F.col("via")).select("node", F.col("end").alias("root"), (F.col("end") < F.col("root")).alias("moved")), "pointers")
                moved = bool(jumped.filter("moved").limit(1).count())
                point = jumped.select("node", "root")
        ends = point.select(F.col("node").alias("via"), F.col("root").alias("end"))
        found = materialize(point if found is None else found.join(ends, F.col("root") == F.col("via"), "left").select("node", F.coalesce("end", "root").alias("root")), "roots")
        of_b = ends.withColumnsRenamed({"via": "via_b", "end": "end_b"})
        drawn = left.join(ends, F.col("a") == F.col("via")).join(of_b, F.col("b") == F.col("via_b")).select(F.col("end").alias("a"), F.col("end_b").alias("b"))
        left = materialize(drawn.filter("a != b").distinct(), "links")
        release(spark, pointers)
        if not left.limit(1).count():
            return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fp long, component_id): one row for each row of ``docs``.

    ``component_id`` is the smallest id that links reach. Null, empty and blank texts have
    fingerprint 0 and are linked like any other; repeated rows each count; a null id gets a row but never
    names a component unless all of its component are null. An empty table gives an empty result; other
    columns are not looked at."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "prints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes.select("fp"), distance))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy(F.col("root").alias("top")).agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(least, F.col("root") == F.col("top")).select(F.col("fp").alias("class_fp"), "component_id"), "named")
    return prints.join(named, F.col("fp") == F.col("class_fp")).select("doc_id", "fp", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one row of each component left, that of the smallest id.

    Rows that share that id too are told apart by their place in the table, so ``docs`` must be one (files, or a checkpoint), not the outcome of a shuffle."""
    uid, kept_uid = fresh(docs, "near_uid", "kept_uid")
    whole = docs.withColumn(uid, F.monotonically_increasing_id())
    ranked = whole.select(F.struct(F.col(f"`{id_col}`").isNull().alias("gone"), F.col(f"`{id_col}`").alias("id"), F.col(uid).alias("uid")).alias("rank"), F.col(f"`{text_col}`").alias("text"))
    found = near_duplicates(ranked, "rank", "text", shingle, distance)
    keep = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.uid").alias(kept_uid))
    return whole.join(keep, F.col(uid) == F.col(kept_uid), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


# --------------------------------------------------------------------------
# Similar texts: candidates by wide fingerprints, and then the Jaccard index itself

LEAST = Fraction(4, 5)
#: Words of 64 bits of a wide fingerprint, bits of a segment, and its weakest bits, one of which is flipped at a time.
WIDE, SEGMENT_BITS, WEAK = 4, 24, 6
#: Bits of a wide fingerprint in which candidates differ at most. Texts of an index J differ in about
#: acos(2J / (1 + J)) / pi of the bits: 39 of 256 at 0.8, give or take 5.8; this is six times that beyond.
WIDE_DISTANCE = 74
#: Of a fingerprint's first 48 bits, those in which they do, and owners of a key up to which that is looked at before whole fingerprints are fetched.
#: At 0.8 texts differ in about 7 of them, give or take 2.5; texts that meet by chance in 24, give or take 3.5.
FIRST_DISTANCE, FEW = 19, 64
#: The other bits of an owner, which are those of its set.
OWN_BITS = 16
#: Top bits of a hash by which shingles are counted.
HEAT_BITS = 16
#: Shingles of a chunk of candidates; of a larger group, chunks are compared two by two.
CHUNK_SHINGLES = 1 << 20


def shingle_set(text: str | bytes | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return np.unique(shingle_hashes(text.encode() if isinstance(text, str) else text, shingle))


def set_id(found: np.ndarray) -> int:
    return int(_U(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def owner_of(wide: np.ndarray, of: int) -> int:
    """The first 48 bits of a wide fingerprint and OWN_BITS of the set's id, as one long: almost a name of the set, from which distances can be told."""
    low = _U((1 << OWN_BITS) - 1)
    return int(((wide[0] & ~low) | (np.int64(of).view(_U) & low)).view(np.int64))


def _wide_lead(found: np.ndarray) -> np.ndarray:
    """By how many of a set's shingles each bit of its wide fingerprint is set rather than not."""
    return np.concatenate([2 * _set_bits(mix(found ^ _U(w * 0x9E3779B97F4A7C15 & (1 << 64) - 1))) - len(found) for w in range(WIDE)]) if len(found) else np.zeros(64 * WIDE, np.int64)


def wide_bits(found: np.ndarray) -> np.ndarray:
    """The wide fingerprint of a set of shingles: WIDE numbers of 64 bits."""
    return np.packbits(_wide_lead(found) > 0, bitorder="little").view("<u8")


def wide_fingerprint(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(``wide_bits``, keys as uint32) of a set of shingles: a key is a segment's number and bits, as they are and with one of its weakest flipped.

    For a search by fingerprints alone, which misses some pairs; ``similar_groups`` needs none of these keys."""
    lead = _wide_lead(found)
    bits, n = lead > 0, len(lead) // SEGMENT_BITS
    own = bits[: n * SEGMENT_BITS].reshape(n, SEGMENT_BITS) @ (1 << np.arange(SEGMENT_BITS))
    weak = 1 << np.argsort(np.abs(lead[: n * SEGMENT_BITS]).reshape(n, SEGMENT_BITS), axis=1, kind="stable")[:, :WEAK]
    ball = np.concatenate([own[:, None], own[:, None] ^ weak], axis=1) | (np.arange(n) << SEGMENT_BITS)[:, None]
    return np.packbits(bits, bitorder="little").view("<u8"), ball.ravel().astype(np.uint32)


def prefix_keys(found: np.ndarray, heat: np.ndarray, least: Fraction) -> np.ndarray:
    """Keys of a set's first shingles, rare ones before common ones: sets of an index of ``least`` or more share one of them, in any order that is the same for all."""
    p = len(found) + least.numerator * len(found) // -least.denominator + 1
    hot = heat[found >> _U(64 - HEAT_BITS)]
    if len(found) > 4 * p:  # no need to sort the rest
        some = hot <= np.partition(hot, p - 1)[p - 1]
        found, hot = found[some], hot[some]
    return ((found[np.argsort(hot, kind="stable")[:p]] & _U(0x7FFFFFFF)) | _U(0x80000000)).astype(np.uint32)


def shingle_heat(docs: DataFrame, shingle: int = 5) -> np.ndarray:
    """How many shingles of ``docs.text`` have hashes of each beginning of HEAT_BITS bits; a fixed number of counts."""
    cut, slices = 1 << HEAT_BITS, 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cut, np.int64)
        for b in batches:
            for _, _, texts in _texts(b.column(0)):
                total += np.bincount((np.concatenate([shingle_set(t, shingle) for t in texts]) >> _U(64 - HEAT_BITS)).astype(np.int64), minlength=cut)
        yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([x.tobytes() for x in total.reshape(slices, -1)], pa.binary())], ["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for s, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[s] = total.get(s, 0) + np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["slice", "counts"])

    kind = "slice int, counts binary"
    rows = docs.select("text").mapInArrow(tidied(count), kind).repartition(slices, "slice").mapInArrow(add, kind).collect()  # 64 rows of 8 KB
    heat = {r["slice"]: np.frombuffer(r["counts"], np.int64) for r in rows}
    return np.concatenate([heat.get(s, np.zeros(cut // slices, np.int64)) for s in range(slices)])


def jaccard_spanning(nodes: np.ndarray, sets: list[np.ndarray], least: Fraction) -> list[tuple[int, int]]:
    """Links that connect whatever an index of ``least`` or more connects; at most one less than there are sets."""
    num, den = least.numerator, least.denominator
    sizes = np.array([len(s) for s in sets], np.int64)
    hashes, owner = np.concatenate(sets), np.repeat(np.arange(len(nodes), dtype=np.int32), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    left, alive, out = np.ones(len(nodes), bool), len(nodes), []
    indexed = alive
    for start in range(len(nodes)):
        if not left[start]:
            continue
        left[start], alive, front = False, alive - 1, [start]
        while front and alive:
            at = front.pop()
            lo, hi = np.searchsorted(hashes, sets[at], "left"), np.searchsorted(hashes, sets[at], "right")
            n = hi - lo
            met = owner[np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if len(n) else owner[:0]
            other, common = np.unique(met[left[met]], return_counts=True)
            near = other[den * common >= num * (sizes[at] + sizes[other] - common)]
            out += [(int(nodes[at]), int(nodes[x])) for x in near]
            left[near], alive = False, alive - len(near)
            front += near.tolist()
            if 2 * alive < indexed:
                stay = left[owner]
                hashes, owner, indexed = hashes[stay], owner[stay], alive
    return out


def candidates(prints: DataFrame, classes: DataFrame, distance: int = WIDE_DISTANCE) -> DataFrame:
    """(a, b) of sets that share a key and whose wide fingerprints are near; what such pairs connect, the links connect.

    ``prints``: (set, owner, keys binary); ``classes``: (set, owner, bits binary), each set once. Keys and owners (``owner_of``) are dealt out first, as most
    keys are of one set, or of sets that the first bits of their fingerprints tell apart. What is left is met with whole fingerprints. Sets of one owner are
    linked without more."""
    parts = spread_of(prints.sparkSession, 3 * (prints.agg(F.sum(F.octet_length("keys"))).first()[0] or 0))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, first = np.unique(np.asarray(b.column(0), np.int64), return_index=True)  # copies meet as one
            nodes = np.asarray(b.column(2), np.int64)[first]
            for i in range(0, len(first), DEAL_ROWS):
                keys = b.column(1).take(pa.array(first[i : i + DEAL_ROWS])).to_pylist()
                yield deal_out(np.frombuffer(b"".join(keys), np.uint32), parts, np.repeat(nodes[i : i + DEAL_ROWS], [len(x) // 4 for x in keys]))

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, owners in gathered(batches):
            key, node = np.frombuffer(b"".join(keys), np.uint32), np.frombuffer(b"".join(owners), np.int64)
            order = np.lexsort((node, key))
            key, node = key[order], node[order]
            new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
            key, node = key[new], node[new]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            many = np.diff(np.append(starts, len(key)))
            many, lead = np.repeat(many, many), node.view(_U) >> _U(OWN_BITS)
            shared = many > FEW
            for step in range(1, FEW):  # rows of a key, each with the one ``step`` rows on
                at = np.flatnonzero((key[step:] == key[:-step]) & (many[step:] <= FEW))
                if not len(at):
                    break
                at = at[np.bitwise_count(lead[at] ^ lead[at + step]) <= FIRST_DISTANCE]
                shared[at] = shared[at + step] = True
            yield pa.RecordBatch.from_arrays([pa.array(key[shared].view(np.int32)), pa.array(node[shared])], ["key", "owner"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links_of(key: np.ndarray, node: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            a, b = met_links(key, node, bits, distance)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        rest = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, WIDE), np.uint64)
        for b in batches:
            own = np.asarray(b.column(0), np.int32), np.asarray(b.column(1), np.int64), np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint64).reshape(-1, WIDE)
            key, node, bits = (np.concatenate(x) for x in zip(rest, own, strict=True))
            if len(key):
                last = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
                rest = key[last:], node[last:], bits[last:]
                if last:
                    yield links_of(key[:last], node[:last], bits[:last])
        if len(rest[0]):
            yield links_of(*rest)

    dealt = prints.select("set", "keys", "owner").mapInArrow(tidied(deal), "part int, keys binary, c0 binary")
    shared = dealt.repartition(parts // 2, "part").sortWithinPartitions("part").mapInArrow(tidied(share), "key int, owner long")
    own = classes.select("set", "bits", F.col("owner").alias("own"))
    known = shared.join(own, F.col("owner") == F.col("own")).select("key", F.col("set").alias("node"), "bits")
    met = known.repartition("key").sortWithinPartitions("key").mapInArrow(tidied(meet), "a long, b long")
    several = own.groupBy(F.col("own").alias("owner")).agg(F.min("set").alias("a"), F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    alike = own.join(several, F.col("own") == F.col("owner")).select("a", F.col("set").alias("b")).filter("a != b")
    return met.union(alike)


def similar_groups(docs: DataFrame, id_col: str, text_col: str = "text", shingle: int = 5, least: Fraction = LEAST, staged: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, component_id) of texts that links of a Jaccard index of ``least`` or more connect; ``id_col``: distinct longs.

    Sets meet by the first of their shingles, which loses none of such an index. Segments of fingerprints would find no pair
    that these don't, and more pairs by chance the more sets there are, so they are no keys. Of what meets, fingerprints that are near
    enough, in their first bits and as a whole, are candidates; and of what candidates connect, the index is counted. Only texts of different
    shingles meet, so copies cost one row. Shingles and sets are told apart by 64-bit hashes.

    staged: the columns of block and place of a staged table; they are in the result too, as block and place."""
    bound_batches(docs.sparkSession)
    where = [F.col(f"`{c}`").alias(n) for c, n in zip(staged, ("block", "place"), strict=True)] if staged else [F.lit(0).cast("long").alias("block"), F.lit(0).alias("place")]
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *where)
    heat = shingle_heat(slim, shingle)

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, texts in _texts(b.column(1)):
                sets = [shingle_set(t, shingle) for t in texts]
                prints = [(wide_bits(s), prefix_keys(s, heat, least)) for s in sets]
                ids = [set_id(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, to - at), b.column(2).slice(at, to - at), b.column(3).slice(at, to - at), pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([owner_of(p, i) for (p, _), i in zip(prints, ids, strict=True)], pa.int64()), pa.array([p.tobytes() for p, _ in prints], pa.binary()), pa.array([k.tobytes() for _, k in prints], pa.binary())],
                    ["doc_id", "block", "place", "set", "n", "owner", "bits", "keys"],
                )

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, texts in _texts(b.column(0)):
                yield pa.RecordBatch.from_arrays([*[c.slice(at, to - at) for c in b.columns[1:]], pa.array([shingle_set(t, shingle).tobytes() for t in texts], pa.binary())], ["root", "chunks", "node", "hashes"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, sets = None, [], []

        def found() -> pa.RecordBatch:
            made = np.array(jaccard_spanning(np.array(nodes, np.int64), sets, least), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], ["a", "b"])

        for b in batches:
            for *group, node, hashes in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if group != at:
                    if len(nodes) > 1:
                        yield found()
                    at, nodes, sets = group, [], []
                nodes.append(node)
                sets.append(np.frombuffer(hashes, np.uint64))
        if len(nodes) > 1:
            yield found()

    prints = materialize(slim.mapInArrow(tidied(sized), "doc_id long, block long, place int, set long, n long, owner long, bits binary, keys binary"), "sets")
    classes = materialize(prints.groupBy("set").agg(F.min(F.struct("doc_id", "block", "place")).alias("first"), F.min("n").alias("n"), F.min("owner").alias("owner"), F.min("bits").alias("bits")), "classes")
    blocks = components(candidates(prints, classes))
    members = materialize(classes.join(blocks, F.col("set") == F.col("node")).select(F.col("first.doc_id").alias("first"), "first.block", "first.place", "node", "root", "n"), "members")
    sizes = members.groupBy(F.col("root").alias("of_root")).agg(F.ceil(F.sum("n") / CHUNK_SHINGLES).cast("int").alias("chunks"))
    placed = members.join(sizes, F.col("root") == F.col("of_root")).select("first", "block", "place", "node", "root", "chunks")
    kind = "root long, chunks int, node long, hashes binary"

    def in_block(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = dict(zip(left.column("place").to_pylist(), left.column("text").to_pylist(), strict=True))
        made = [shingle_set(texts[p], shingle).tobytes() for p in right.column("place").to_pylist()] if left.num_rows else []
        rows = right if left.num_rows else right.slice(0, 0)
        return pa.table({"root": rows.column("root"), "chunks": rows.column("chunks"), "node": rows.column("node"), "hashes": pa.array(made, pa.binary())})

    if staged:  # what is known of candidates goes to their blocks, and no text moves
        chosen = is_marked(slim, "block", "place", members.select("block", "place"), "chosen").filter("chosen").select("block", "place", "text")
        held = chosen.groupBy("block").cogroup(placed.select("block", "place", "root", "chunks", "node").groupBy("block")).applyInArrow(in_block, kind)
    else:
        held = slim.join(placed.select("first", "node", "root", "chunks"), F.col("doc_id") == F.col("first")).select("text", "root", "chunks", "node").mapInArrow(tidied(with_sets), kind)
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(F.least(chunk, j).alias("lo"), F.greatest(chunk, j).alias("hi")))
    dealt = held.select("root", F.inline(pairs), "node", "hashes")
    edges = dealt.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "node").mapInArrow(tidied(verified), "a long, b long")
    roots = components(edges)
    rooted = prints.join(roots, F.col("set") == F.col("node"), "left").select("doc_id", "block", "place", F.coalesce("root", "set").alias("root"))
    first = rooted.groupBy(F.col("root").alias("top")).agg(F.min("doc_id").alias("component_id"))
    return rooted.join(first, F.col("root") == F.col("top")).select("doc_id", "component_id", *(["block", "place"] if staged else []))


def dedup_similar(docs: DataFrame, text_col: str = "text", shingle: int = 5, least: Fraction = LEAST) -> DataFrame:
    """``docs`` with the first row of each group of similar texts left, by place; ``docs`` must be a table (files, or a checkpoint), not the outcome of a shuffle.

    Null, empty and blank texts are one group; repeated rows are; an empty table gives an empty result."""
    uid, block, place, gone = fresh(docs, "near_uid", "near_block", "near_place", "near_gone")
    whole, _ = stage(docs.withColumn(uid, F.monotonically_increasing_id()), text_col, block, place_col=place)
    found = similar_groups(whole, uid, text_col, shingle, least, (block, place))
    marks = found.filter("doc_id != component_id").select("block", "place")
    return is_marked(whole, block, place, marks, gone).filter(~F.col(gone)).select(*[F.col(f"`{c}`") for c in docs.columns])
