"""Keyed tables fed by file streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, path: str, schema: str, kind: str = "parquet", per_trigger: int = 100) -> DataFrame:
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_trigger).load(path)


def upsert_into(stream: DataFrame, read: Callable[[], DataFrame | None], write: Callable[[DataFrame, int], None], combine: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Each micro-batch is combined with the table as it is, and the result is written as the batch's version; a batch that comes again writes the same."""

    def step(batch: DataFrame, number: int) -> None:
        old = read()
        write(combine(old, batch) if old is not None else batch, number)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once(stream: DataFrame, keys: list[str], time: str, late: str = "1 day") -> DataFrame:
    """Each key once within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def tumbling_counts(stream: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), kind, "n")
