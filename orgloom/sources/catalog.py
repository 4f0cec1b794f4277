"""Scans, exports and catalog questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def source(kind: str) -> Callable:
    """Registers a reader (spark, **options) -> DataFrame."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _REGISTRY[kind] = f
        return f

    return add


def open_source(spark: SparkSession, kind: str, **options: str) -> DataFrame:
    if kind not in _REGISTRY:
        raise ValueError(f"no source of kind {kind!r}; there are {sorted(_REGISTRY)}")
    return _REGISTRY[kind](spark, **options)


@source("csv")
def csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, columns: dict[str, str] | None = None, multi_line: bool = False, sample: float = 1.0) -> DataFrame:
    """A CSV with a header, its types inferred from a share ``sample`` of its rows without a schema; columns: new name of each column wanted.

    multi_line: values in quotes may hold line breaks; then a file is one task, else tasks share it."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("samplingRatio", sample)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()]) if columns else df


@source("json")
def json(spark: SparkSession, path: str, schema: str | T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


@source("parquet")
def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


@source("table")
def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


@source("jdbc")
def jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, lower: int = 0, upper: int = 0, parts: int = 1, **properties: str) -> DataFrame:
    """A table behind a JDBC driver, read in ``parts`` ranges of ``column`` if there is one."""
    if column:
        return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


@source("files")
def files(spark: SparkSession, path: str, pattern: str = "*", max_files: int | None = None) -> DataFrame:
    """(path, folder, name, extension, size, modified) of the files below a folder, without reading them."""
    from ..functions.text import path_parts

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")
    folder, name, extension = path_parts(F.col("path"))
    out = found.select("path", folder.alias("folder"), name.alias("name"), extension.alias("extension"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return out.orderBy("path").limit(max_files) if max_files else out


def landed(df: DataFrame, updated: str, cutoff: str, strict: bool = False, order: bool = False) -> DataFrame:
    """Records landed from an API whose ``updated`` time is at or after (strict: after) the cutoff."""
    limit = F.lit(cutoff).cast(df.schema[updated].dataType)
    rows = df.filter(F.col(updated) > limit if strict else F.col(updated) >= limit)
    return rows.orderBy(updated) if order else rows


def since_days(df: DataFrame, column: str, as_of: str, days: int = 90) -> DataFrame:
    return df.filter(F.col(column) >= F.expr(f"timestamp_ntz'{as_of}' - INTERVAL {days} DAYS"))


def list_tables(spark: SparkSession) -> DataFrame:
    """(schema_name, table_name) of the catalog's tables, in order."""
    rows = [(d.name, t.name) for d in spark.catalog.listDatabases() for t in spark.catalog.listTables(d.name) if t.tableType != "VIEW" and not t.isTemporary]
    return spark.createDataFrame(sorted(rows), "schema_name string, table_name string")


def columns_of(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, ordinal, column_name, column_type) of some tables, from their schemas alone."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(n, i, f.name, f.dataType.simpleString()) for n, df in sorted(tables.items()) for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table_name string, ordinal long, column_name string, column_type string")


EMPTY = ("", "[]", "{}", "null", "none")


def column_examples(df: DataFrame, order: str, rows: int = 100) -> DataFrame:
    """(column_name, example): of each column the first value that is not empty in the first rows in ``order``."""
    text = df.orderBy(order).limit(rows).select(F.col(order).alias("first_by"), *[F.col(c).cast("string").alias(f"c_{c}") for c in df.columns])
    full = lambda c: F.when(~F.lower(F.trim(F.col(c))).isin(*EMPTY), F.struct("first_by", F.col(c).alias("v")))
    one = text.agg(*[F.min(full(f"c_{c}")).alias(f"c_{c}") for c in df.columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c_{c}.v").alias("example")) for c in df.columns])))


def has_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def counted_write(df: DataFrame, path: str, mode: str = "append", kind: str = "parquet") -> tuple[int, int]:
    """Writes ``df``; (rows there before, rows there after)."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    before = spark.read.format(kind).load(path).count() if there else 0
    df.write.mode(mode).format(kind).save(path)
    return before, spark.read.format(kind).load(path).count()


def export_csv(df: DataFrame, path: str, first: int | None = None, order: list[str] | None = None) -> None:
    """The table, or its first rows in an order, as CSV with a header."""
    rows = (df.orderBy(*order) if order else df).limit(first) if first else df
    rows.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export_graph(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    """Vertices by kind and edges by kind, replacing what was there."""
    vertices.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/vertices")
    edges.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/edges")
