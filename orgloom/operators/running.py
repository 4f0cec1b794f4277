"""Running sums by key without one task for a key.

A window over a key gathers the whole key in one task. Here rows are sorted over all tasks by key and order, each task sums up its own
stretch, and what a key had in the tasks before is added once it is known: at most one number for each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..sources.scratch import written


def _begins(columns: list[pa.Array], last: list[pa.Scalar] | None) -> np.ndarray:
    """Whether a key begins at each row; ``last`` is the key of the row before."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    for i, c in enumerate(columns):
        before = pa.concat_arrays([pa.array([last[i].as_py()], c.type) if last else c.slice(0, 1), c.slice(0, n - 1)])
        same = pc.if_else(pc.and_(pc.is_null(before), pc.is_null(c)), True, pc.fill_null(pc.equal(before, c), False))
        out |= ~np.asarray(same, bool)
    if last is None and n:
        out[0] = True
    return out


def running(rows: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with a column for each of ``sums``: the sum (long) of its values in the rows of the same ``keys`` up to this one, in ``order``.

    Nulls are a key too, and count as zero in sums; of rows that are equal in ``order`` any may come first. Rows are sorted and
    written once, so they should be ids and numbers, and no texts; a key may hold any share of them."""
    begin = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    valued = rows.withColumns({c: F.coalesce(v.cast("long"), F.lit(0).cast("long")) for c, v in sums.items()})
    # Copies of one place, however many, are dealt out by the last column.
    salted = valued.withColumn("running_salt", F.pmod(F.monotonically_increasing_id(), F.lit(1024)))
    dealt = salted.repartitionByRange(*begin, *order, "running_salt").sortWithinPartitions(*begin, *order).drop("running_salt")
    names, place = list(sums), {c: i for i, c in enumerate(dealt.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, nth, at, carried = TaskContext.get().partitionId(), None, -1, 0, dict.fromkeys(names, 0)
        for b in batches:
            if not b.num_rows:
                continue
            key = [b.column(place[k]) for k in keys]
            new = _begins(key, last)
            which = np.cumsum(new)  # 0: the key of the batch before
            starts = np.flatnonzero(new)
            columns = list(b.columns)
            for c in names:
                total = np.cumsum(np.asarray(b.column(place[c])))
                before = np.concatenate([np.array([-carried[c]]), np.where(starts > 0, total[starts - 1], 0)])[which]
                upto = total - before
                carried[c] = int(upto[-1])
                columns[place[c]] = pa.array(upto, pa.int64())
            marks = [pa.array(np.full(b.num_rows, part), pa.int32()), pa.array(nth + which, pa.int64()), pa.array(at + np.arange(b.num_rows), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *marks], [*b.schema.names, "running_part", "running_key", "running_at"])
            last, nth, at = [k[-1] for k in key], nth + int(which[-1]), at + b.num_rows

    kinds = [StructField(f.name, f.dataType, True) for f in dealt.schema]
    local = written(dealt.mapInArrow(run, StructType([*kinds, StructField("running_part", IntegerType()), StructField("running_key", LongType()), StructField("running_at", LongType())])), "running")
    # Only the first key of a task can have begun in another one.
    firsts = local.filter("running_key = 0").select("running_part", *[F.col(f"`{k}`").alias(f"first_{k}") for k in keys]).distinct()
    of = [F.col(f"`{k}`").eqNullSafe(F.col(f"first_{k}")) for k in keys]
    known = firsts.drop("running_part").distinct()  # a row for each task at most, as are the next two
    totals = local.join(F.broadcast(known), of, "left_semi").groupBy("running_part", "running_key", *keys).agg(*[F.max_by(c, "running_at").alias(c) for c in names])
    before = Window.partitionBy(*keys).orderBy("running_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumns({c: F.sum(c).over(before) for c in names}).filter("running_key = 0").select(F.col("running_part").alias("offset_part"), *[F.col(c).alias(f"offset_{c}") for c in names])
    met = local.join(F.broadcast(offsets), F.when(F.col("running_key") == 0, F.col("running_part")) == F.col("offset_part"), "left")
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], *[(F.col(c) + F.coalesce(f"offset_{c}", F.lit(0).cast("long"))).alias(c) for c in names])

