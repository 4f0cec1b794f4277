"""Folders for tables that only live for a while."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders that this process has given out, with their sessions.
_given: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A new folder that the driver and all executors share: below ``spark.checkpoint.dir``, or, with a local master only, below /tmp.

    ``release`` deletes it, at the latest when the process ends."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{(given or '/tmp/checkpoints').rstrip('/')}/orgloom-{tag}-{uuid.uuid4().hex}"
    _given.append((spark, path))
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in a scratch folder."""
    path = scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the scratch folders of the session, and say how many. Results that still read them can't be evaluated afterwards."""
    mine = [x for x in _given if x[0] is spark]
    for item in mine:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(item[1])
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _given.remove(item)
    return len(mine)


def _at_exit() -> None:
    for spark in {id(x[0]): x[0] for x in _given}.values():
        try:
            release(spark)
        except Exception:  # the JVM may be gone by now
            pass


atexit.register(_at_exit)
