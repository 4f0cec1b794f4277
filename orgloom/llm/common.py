"""Helpers shared by the training-data operators.

Scratch tables live under the folder that the cluster names in
``spark.checkpoint.dir``; every executor and the driver can read them, so a lost
executor costs a re-read and no more.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where ``spark.checkpoint.dir`` is unset; for a local master only.
LOCAL_SHARED = "/tmp/checkpoints"
#: Bytes of text that one numpy pass works on; a longer single text is a pass of its own.
CHUNK_BYTES = 2 << 20

#: (session, path, table if there is one, owner if there is one)
_scratch: list[tuple[SparkSession, str, str | None, str | None]] = []
_owner: list[str] = []


@contextlib.contextmanager
def owned(owner: str) -> Iterator[None]:
    """Scratch tables that are made meanwhile are the owner's, who may release them before the session ends."""
    _owner.append(owner)
    try:
        yield
    finally:
        _owner.pop()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, a fixed local one if the master is local too, else an error."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (given or LOCAL_SHARED).rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/orgloom-{uuid.uuid4().hex}-{tag}"
    _scratch.append((spark, path, None, _owner[-1] if _owner else None))
    return path


#: Pages and row groups of scratch tables: small enough that neither their writers nor their readers hold much at once.
WRITTEN = {"parquet.page.size": str(256 << 10), "parquet.block.size": str(32 << 20)}


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    path = scratch_path(df.sparkSession, tag)
    df.write.options(**WRITTEN).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, owner: str | None = None, still: DataFrame | None = None) -> None:
    """Delete every scratch table that this session's operators have written, or those of an owner that ``still`` does not read.

    Results that still read them can't be evaluated afterwards."""
    jvm = spark.sparkContext._jvm
    read = {f.split(":", 1)[-1].lstrip("/") for f in still.inputFiles()} if still is not None else set()
    for item in [x for x in _scratch if x[0] is spark and (owner is None or x[3] == owner)]:
        _, path, table, _ = item
        bare = path.split(":", 1)[-1].lstrip("/") + "/"
        if any(f.startswith(bare) for f in read):
            continue
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        _scratch.remove(item)
    if owner is None:
        unbound_batches(spark)


def _at_exit() -> None:
    for spark in {id(x[0]): x[0] for x in _scratch}.values():
        try:
            release(spark)
        except Exception:  # the JVM may be gone by now
            pass


atexit.register(_at_exit)


#: The database of bucketed scratch tables, so that none is among the user's own.
SCRATCH_DATABASE = "orgloom_scratch"


def scratch_table(spark: SparkSession, tag: str) -> tuple[str, str]:
    """(name, path) of a scratch table that ``release`` drops."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{shared_dir(spark)}/{SCRATCH_DATABASE}'")
    name, path = f"{SCRATCH_DATABASE}.t{uuid.uuid4().hex}", scratch_path(spark, tag)
    _scratch.append((spark, path, name, _owner[-1] if _owner else None))
    return name, path


#: Bytes of text of a block, about; and the most buckets of a staged table.
BLOCK_BYTES, MOST_BUCKETS = 16 << 20, 1 << 14


def stage(df: DataFrame, text_col: str, block_col: str, block_bytes: int = BLOCK_BYTES, place_col: str | None = None) -> tuple[DataFrame, int]:
    """(a written table of ``df`` in buckets, with the number of each row's block and its place there, the number of blocks); no row changes its machine.

    What is later joined to it by block moves to the texts, and no text moves. Blocks have about ``block_bytes`` of text;
    a longer text is in a block of its own size. ``df`` must be a table (files, or a checkpoint)."""
    spark = df.sparkSession
    text = F.col(f"`{text_col}`").cast("string")
    size = df.select(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 16)).first()[0] or 0
    tasks = max(1, df.rdd.getNumPartitions())
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // block_bytes))
    each = -(-blocks // tasks)  # blocks of a task that reads
    blocks = tasks * each
    block = F.spark_partition_id().cast("long") * each + F.pmod(F.monotonically_increasing_id(), F.lit(each))
    if blocks <= 1 << 12:  # numbers that go to a bucket of their own; of more blocks, chance makes buckets about equal
        found = spark.range(0, 24 * blocks, numPartitions=1).groupBy(F.pmod(F.hash("id"), F.lit(blocks)).alias("slot")).agg(F.min("id").alias("id")).collect()
        numbers = sorted(r["id"] for r in found)
        numbers += range(24 * blocks, 25 * blocks - len(numbers))
        block = F.element_at(F.array(*[F.lit(x).cast("long") for x in numbers]), (block + 1).cast("int"))
    name, path = scratch_table(spark, "blocks")
    if place_col:
        df = df.withColumn(place_col, F.floor(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) / each).cast("int"))
    df.withColumn(block_col, block).write.options(**WRITTEN).bucketBy(min(blocks, MOST_BUCKETS), block_col).option("path", path).saveAsTable(name)
    return spark.table(name), blocks


def is_marked(staged: DataFrame, block_col: str, place_col: str, marks: DataFrame, mark_col: str) -> DataFrame:
    """A staged table with whether a row's (block, place) is in ``marks``: one row of bits for each block goes to its texts."""

    def bits(key: tuple, rows: pa.Table) -> pa.Table:
        places = rows.column("place").to_numpy()
        made = np.zeros(int(places.max()) // 8 * 8 + 8, bool)
        made[places] = True
        return pa.table({"mark_block": pa.array([key[0].as_py()], pa.int64()), mark_col: pa.array([np.packbits(made).tobytes()], pa.binary())})

    (mark_block,) = fresh(staged, "mark_block")
    packed = marks.groupBy("block").applyInArrow(bits, f"mark_block long, `{mark_col}` binary").withColumnRenamed("mark_block", mark_block)
    met = staged.join(packed.hint("shuffle_hash"), F.col(block_col) == F.col(mark_block), "left")
    byte = F.conv(F.hex(F.substring(F.col(mark_col), F.floor(F.col(place_col) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(F.coalesce(byte, F.lit(0)), 7 - F.col(place_col) % 8) == 1
    return met.withColumn(mark_col, F.when(F.col(mark_col).isNull(), F.lit(False)).otherwise(bit)).drop(mark_block)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


#: Session options that bound what a task holds at once, as rows are whole texts: bytes of an Arrow batch (Spark's default is
#: 64 MB), and rows of a batch that the Parquet reader decodes (4,096).
BOUNDS = {"spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20, "spark.sql.parquet.columnarReaderBatchSize": 128}


#: (session, option, what it was) of options that ``bound_batches`` has lowered.
_lowered: list[tuple[SparkSession, str, str]] = []


def bound_batches(spark: SparkSession) -> None:
    """Lower the options of BOUNDS to what is there, if they are higher; ``unbound_batches``, and ``release`` of all tables, put them back.

    Spark reads them when a result is evaluated, which is after an operator has returned."""
    for key, most in BOUNDS.items():
        was = spark.conf.get(key)
        given = re.fullmatch(r"(\d+)b?", was)
        if given and not 0 < int(given[1]) <= most:
            _lowered.append((spark, key, was))
            spark.conf.set(key, str(most))


def unbound_batches(spark: SparkSession) -> None:
    """Put back what ``bound_batches`` has lowered, but for what was set anew since."""
    for item in [x for x in reversed(_lowered) if x[0] is spark]:
        _, key, was = item
        if spark.conf.get(key) == str(BOUNDS[key]):
            spark.conf.set(key, was)
        _lowered.remove(item)


def collect_garbage(spark: SparkSession) -> None:
    """Ask the JVMs of all executors, and the driver's, to collect their garbage now, after which they give memory of their heaps back.

    A heap that has grown while texts went by is not given back before a full collection; Python workers need that memory. With a local
    master there is one JVM alone."""
    spark.sparkContext._jvm.System.gc()
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        return
    n = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


def keep_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under fixed names, whatever else the table holds."""
    bound_batches(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def give_back() -> None:
    """Free memory of this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not in every C library
        ctypes.CDLL(None).malloc_trim(0)


def tidied(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """An Arrow function that gives its free memory back to the system at the end of a task, as its worker lives on."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


# --------------------------------------------------------------------------
# numpy over the bytes of Arrow string arrays

def byte_table(separators: bytes) -> np.ndarray:
    """bool[256]: True for bytes that belong to words."""
    table = np.ones(256, bool)
    table[np.frombuffer(separators, np.uint8)] = False
    return table


SPACE = byte_table(b" \t\n\x0b\x0c\r")
#: Once A-Z are lower-cased, 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F part words; here A-Z still are themselves.
NON_WORD = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def chunks_of(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of rows in the bytes) of pieces of about ``limit`` bytes.

    Rows stay whole; null rows have no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # of no or several pieces
        base = 0
        for piece in texts.chunks:
            for a, b, data, offs in chunks_of(piece, limit):
                yield a + base, b + base, data, offs
            base += len(piece)
        return
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type)
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, to, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte) of each word, and the index of each row's first word (one more entry at the end).

    Words never cross rows."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    w = is_word[data]
    begins = w.copy()
    begins[1:] &= ~w[:-1]
    ends = w.copy()
    ends[:-1] &= ~w[1:]
    inner = offs[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = w[inner]
    ends[inner - 1] = w[inner - 1]
    st, en = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return st, en, np.searchsorted(st, offs)


_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, in place."""
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], _U)
#: Words of more bytes are hashed one by one.
_LONG = 64


class WordHasher:
    """64-bit hashes of the words of a byte buffer, alike on every machine.

    Blocks of eight bytes are mixed one after the other, so no structure of a word, but chance alone, makes two hashes equal."""

    def __init__(self, seed: int = 7, lower: bool = False):
        self.seed, self.lower = seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1, lower

    def __call__(self, data: np.ndarray, st: np.ndarray, en: np.ndarray) -> np.ndarray:
        if not len(st):
            return np.zeros(0, _U)
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[: len(data)] = LOWER[data] if self.lower else data
        blocks = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
        size = en - st
        h = mix(size.astype(_U) ^ _U(self.seed))
        h ^= blocks[st] & _MASKS[np.minimum(size, 8)]
        mix(h)
        more, at = np.flatnonzero((size > 8) & (size <= _LONG)), 8
        while len(more):
            h[more] = mix(h[more] ^ (blocks[st[more] + at] & _MASKS[np.minimum(size[more] - at, 8)]))
            at += 8
            more = more[size[more] > at]
        for i in np.flatnonzero(size > _LONG).tolist():
            h[i] = xxhash.xxh64_intdigest(padded[st[i] : en[i]].tobytes(), self.seed)
        return h


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    z = a * _U(0x9E6C63D0876A9A47)
    z ^= b
    z ^= z >> _U(32)
    z *= _U(0xD6E8FEB86659FD93)
    z ^= z >> _U(29)
    return z


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of h[i : i + k] for each i, by doubling: two hashes of n make one of 2n."""
    out, covered, have, n = None, 0, 1, len(h)
    if n < k:
        return np.zeros(0, _U)
    while True:
        if k & have:
            m = n - covered - have + 1
            out = h[:m] if out is None else _joined(out[:m], h[covered : covered + m])
            covered += have
        if covered == k:
            return out
        h = _joined(h[:-have], h[have:])
        have *= 2
