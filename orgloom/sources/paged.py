"""Records in pages, as APIs hand them out: one file of JSON lines for each page, below one folder for each source.

``<path>/<source column>=<source>/page=<n>/*.json``. Pages of a source may be in descending order of a time, as an API gives what was
updated last; then a reader that wants what is newer than a cutoff stops at the first page that ends before it, and never
opens those behind. A source is read by several tasks, each of which has a run of its pages.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.json
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.running import running
from .scratch import scratch_dir

FORMAT = "orgloom_pages"
#: Times in full, whatever the session's zone.
TIMES = {"timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Pages of one source that a task reads, at most.
RUN = 32


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path that every executor can open, and the path in it; local paths go without a scheme."""
    plain = re.sub(r"^file:/+", "/", path)
    return (pyarrow.fs.LocalFileSystem(), plain) if plain.startswith("/") else pyarrow.fs.FileSystem.from_uri(path)


@dataclass
class PageRun(InputPartition):
    """Folders of consecutive pages of one source."""

    source: str
    pages: list[str]


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema
        self.source, self.time = options.get("source", "source"), options.get("newest_first")
        self.run = int(options.get("pages_of_a_task", RUN))
        self.cutoff: datetime.datetime | None = None
        self.only: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """A cutoff of the time stops readers early, values of the source choose folders. Spark applies the cutoff to rows again."""
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == (self.time,):
                self.cutoff = max(self.cutoff or f.value, f.value)
                yield f
            elif isinstance(f, (EqualTo, In)) and f.attribute == (self.source,):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = values if self.only is None else self.only & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Names of folders alone are listed here; what pages hold, tasks find out."""
        store, root = _store(self.path)
        runs: list[InputPartition] = []
        for folder in sorted(store.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True)), key=lambda x: x.base_name):
            name, _, value = folder.base_name.partition("=")
            value = re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)
            if name != self.source or folder.type != pyarrow.fs.FileType.Directory or (self.only is not None and value not in self.only):
                continue
            pages = [p for p in store.get_file_info(pyarrow.fs.FileSelector(folder.path)) if p.base_name.startswith("page=")]
            pages.sort(key=lambda p: int(p.base_name[5:]))
            runs += [PageRun(value, [p.path for p in pages[i : i + self.run]]) for i in range(0, len(pages), self.run)]
        return runs or [PageRun("", [])]

    def read(self, partition: PageRun) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        shape = to_arrow_schema(self.schema)
        inside = pa.schema([f for f in shape if f.name != self.source])
        for page in partition.pages:
            files = sorted(f.path for f in store.get_file_info(pyarrow.fs.FileSelector(page)) if f.base_name.endswith(".json") and f.size)
            oldest = None
            for file in files:
                with store.open_input_stream(file) as stream:
                    rows = pyarrow.json.read_json(stream, parse_options=pyarrow.json.ParseOptions(explicit_schema=inside, unexpected_field_behavior="ignore"))
                columns = [pa.array([partition.source] * len(rows), pa.string()) if f.name == self.source else rows.column(f.name).combine_chunks() for f in shape]
                yield from pa.Table.from_arrays(columns, schema=shape).to_batches()
                if self.time and len(rows):
                    oldest = rows.column(self.time)[-1].as_py()
            if self.cutoff is not None and oldest is not None and oldest < _like(oldest, self.cutoff):
                return  # what follows is older still


def _like(sample: datetime.datetime, given: datetime.datetime) -> datetime.datetime:
    """``given`` with a zone if ``sample`` has one, without if it has none; both are UTC then."""
    if sample.tzinfo is None:
        return given.astimezone(datetime.UTC).replace(tzinfo=None) if given.tzinfo else given
    return given if given.tzinfo else given.replace(tzinfo=datetime.UTC)


class PagedRecords(DataSource):
    """Options: path, source (the column that folders name), newest_first (the time that pages descend by, if they do), pages_of_a_task."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        raise ValueError("pages have no schema of their own; give one")

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(dict(self.options), schema)


def paged(spark: SparkSession, path: str, schema: StructType, source: str, newest_first: str | None = None, pages_of_a_task: int = RUN) -> DataFrame:
    """The records of pages; filters of the source and, where pages descend, of the time reach the reader.

    Spark keeps what a plan has pushed to a reader for the next plan of the same table, if that one pushes nothing. So every plan
    gets a filter that it pushes: that there is a source."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedRecords)
    reader = spark.read.format(FORMAT).schema(schema).option("path", path).option("source", source).option("pages_of_a_task", pages_of_a_task)
    return (reader.option("newest_first", newest_first) if newest_first else reader).load().filter(F.col(source).isNotNull())


def land_pages(rows: DataFrame, source: str, order: list[Column], page_size: int, tag: str = "pages") -> tuple[str, StructType]:
    """(folder, schema) of ``rows`` landed in pages of ``page_size``, each source's in ``order``; a source may hold any share of the rows.

    Records without a source are left out, as no folder names them."""
    kept = rows.filter(F.col(source).isNotNull())
    placed = running(kept, [source], order, {"page_nth": F.lit(1)})
    numbered = placed.withColumn("page", F.floor((F.col("page_nth") - 1) / page_size).cast("int"))
    path = scratch_dir(rows.sparkSession, tag)
    dealt = numbered.repartition(F.col(source), F.col("page")).sortWithinPartitions(source, "page", "page_nth").drop("page_nth")
    dealt.write.options(**TIMES).partitionBy(source, "page").json(path)
    fields = [StructField(f.name, StringType() if f.name == source else f.dataType, True) for f in rows.schema]
    return path, StructType(fields)
