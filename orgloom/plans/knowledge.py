"""The schema knowledge base: chunks of a catalog, metadata filters, nearest vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.adapters import load, with_sql
from . import compiler
from .compiler import ColumnSelection, Plan, TargetSchema

SCHEMA_JSON = "schema struct<tables:array<struct<name:string,description:string,columns:array<struct<name:string,description:string,type_details:string>>>>>"


def chunks(documents: DataFrame, column: str, source: str) -> DataFrame:
    """(id, document, kind, table_name, column_name) of each table and column of JSON schema descriptions."""
    parsed = documents.select(F.explode(F.from_json(F.col(column), SCHEMA_JSON)["schema"]["tables"]).alias("t"))
    tables = parsed.select(F.concat_ws(".", F.lit(source), "t.name").alias("id"), F.concat_ws(": ", "t.name", "t.description").alias("document"), F.lit("table").alias("kind"), F.col("t.name").alias("table_name"), F.lit(None).cast("string").alias("column_name"))
    columns = parsed.select("t.name", F.explode("t.columns").alias("c")).select(F.concat_ws(".", F.lit(source), "name", "c.name").alias("id"), F.concat_ws(" | ", "c.name", "c.description", "c.type_details").alias("document"), F.lit("column").alias("kind"), F.col("name").alias("table_name"), F.col("c.name").alias("column_name"))
    return tables.unionByName(columns)


def where(base: DataFrame, **equal: object) -> DataFrame:
    """Rows whose metadata equal all the values."""
    for k, v in equal.items():
        base = base.filter(F.col(k) == F.lit(v))
    return base


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def nearest(base: DataFrame, query: list[float], k: int = 5) -> DataFrame:
    """The k vectors of largest cosine, ids deciding among equals."""
    return base.withColumn("score", F.round(cosine(F.col("EMBEDDING"), F.array(*[F.lit(float(x)) for x in query])), 6)).orderBy(F.desc("score"), "ID").limit(k).select("ID", "LABEL", "score")


#: Queries that meet the vectors together.
PACK = 4096
#: Pairs of a query and a row that a task scores at once, about: 2 MB for each matrix.
PAIRS_AT_ONCE = 1 << 18


def nearest_each(base: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest of each of some queries; ``queries`` is a stated set, met by all rows in packs of at most PACK.

    A batch of vectors gives the k best of each query there, so no pair is a row, and what is left is ranked again."""
    spark, found, rows = base.sparkSession, [], []

    def meet(rows: list) -> DataFrame:
        given = spark.sparkContext.broadcast((np.array([r["ID"] for r in rows], np.int64), np.array([r["EMBEDDING"] for r in rows], np.float64)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, q = given.value
            sizes, step = (q * q).sum(axis=1), max(1, PAIRS_AT_ONCE // len(q))
            for b in batches:
                own = np.asarray(b.column(0), np.int64)
                best, who = np.empty((len(q), 0)), np.empty((len(q), 0), np.int64)
                for s in range(0, len(own), step):
                    v = np.array(b.column(1).slice(s, step).to_pylist(), np.float64)
                    score = np.round((q @ v.T) / np.sqrt(np.outer(sizes, (v * v).sum(axis=1))), 6)
                    best, who = np.hstack([best, score]), np.hstack([who, np.broadcast_to(own[s : s + step], score.shape)])
                    first = np.lexsort((who, -best), axis=1)[:, :k]
                    best, who = np.take_along_axis(best, first, axis=1), np.take_along_axis(who, first, axis=1)
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, best.shape[1])), pa.array(who.ravel()), pa.array(best.ravel())], ["QUERY_ID", "ID", "score"])

        return base.filter("EMBEDDING IS NOT NULL").select(F.col("ID").cast("bigint").alias("ID"), "EMBEDDING").mapInArrow(run, "QUERY_ID long, ID long, score double")

    for r in queries.filter("EMBEDDING IS NOT NULL").select("ID", "EMBEDDING").toLocalIterator():
        rows.append(r)
        if len(rows) == PACK:
            found.append(meet(rows))
            rows = []
    if rows or not found:
        found.append(meet(rows) if rows else spark.createDataFrame([], "QUERY_ID long, ID long, score double"))
    w = Window.partitionBy("QUERY_ID").orderBy(F.desc("score"), "ID")
    ranked = reduce(DataFrame.unionByName, found).withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= k)
    return ranked.select("QUERY_ID", "ID", "score", F.col("nth").cast("bigint").alias("nth"))


def answer(base: DataFrame, goal: list[float], planner: Callable[[list], Plan], tables: dict[str, DataFrame], k: int = 5) -> DataFrame:
    """(platform, table_name, row) from a goal to rows: the k chunks nearest to the goal's vector, the plan that ``planner`` makes of them, and the rows of its targets, platform by platform."""
    plan = planner(nearest(base, goal, k).collect())  # k rows
    found = [df.select(F.lit(p).alias("platform"), "table_name", "row") for p, df in compiler.run(base.sparkSession, plan, tables).items()]
    return reduce(DataFrame.unionByName, found) if found else base.sparkSession.createDataFrame([], "platform string, table_name string, row string")


def _plan_of(chunks: list) -> Plan:
    """The accounts of a platform for each kind of chunk that is near."""
    near = {r["LABEL"] % 2 for r in chunks}
    both = {0: TargetSchema("github", "commits", [ColumnSelection("AUTHOR_LOGIN", "identity")], None, "distinct"), 1: TargetSchema("jira", "issues", [ColumnSelection("REPORTER_ACCOUNT_ID", "identity")], "STATUS_NAME = 'O'", "distinct")}
    return Plan([both[x] for x in sorted(near)])


def _identities(s: SparkSession, d: str) -> DataFrame:
    rows = answer(load(s, d, "kb"), _query(s, d), _plan_of, {n: load(s, d, n) for n in ("commits", "issues")})
    return rows.select("platform", "table_name", F.get_json_object("row", "$.identity").alias("identity"))


def _schema_docs(s: SparkSession, d: str) -> DataFrame:
    """Descriptions of tables as JSON, one for each nation."""
    return load(s, d, "nation").selectExpr("""'{"schema": {"tables": [{"name": "' || n_name || '", "description": "Table ' || CAST(n_nationkey AS STRING) || '", "columns": [{"name": "id", "description": "key", "type_details": "int"}, {"name": "c' || CAST(n_regionkey AS STRING) || '", "description": "value", "type_details": "text"}]}]}}' AS doc""")


def _query(spark: SparkSession, d: str) -> list[float]:
    return load(spark, d, "kb").filter("ID = 7").first()["EMBEDDING"]


_COS = "round(list_inner_product(a.EMBEDDING::DOUBLE[], b.EMBEDDING::DOUBLE[]) / sqrt(list_inner_product(a.EMBEDDING::DOUBLE[], a.EMBEDDING::DOUBLE[]) * list_inner_product(b.EMBEDDING::DOUBLE[], b.EMBEDDING::DOUBLE[])), 6)"
QUERIES = {
    "vector_topk": lambda s, d: nearest(load(s, d, "kb"), _query(s, d), 10),
    "vector_topk_batch": lambda s, d: nearest_each(load(s, d, "kb"), load(s, d, "kb").filter("ID % 50 = 0"), 5),
    "kb_chunks": lambda s, d: chunks(_schema_docs(s, d), "doc", "src"),
    "kb_listing": lambda s, d: chunks(_schema_docs(s, d), "doc", "src").filter("kind = 'table'").select("table_name", "document").orderBy("table_name"),
    "goal_to_identities": _identities,
    "kb_metadata_filter": lambda s, d: where(load(s, d, "kb"), LABEL=1, TABLE_NAME="table_1").select("ID", "LABEL", "TABLE_NAME"),
}
ORACLES = {
    "kb_chunks": """SELECT 'src.' || n_name AS id, n_name || ': Table ' || n_nationkey AS document, 'table' AS kind, n_name AS table_name, NULL AS column_name FROM nation
UNION ALL SELECT 'src.' || n_name || '.id', 'id | key | int', 'column', n_name, 'id' FROM nation UNION ALL SELECT 'src.' || n_name || '.c' || n_regionkey, 'c' || n_regionkey || ' | value | text', 'column', n_name, 'c' || n_regionkey FROM nation""",
    "kb_listing": "SELECT n_name AS table_name, n_name || ': Table ' || n_nationkey AS document FROM nation ORDER BY 1",
    "goal_to_identities": with_sql(f"""WITH top AS (SELECT a.LABEL % 2 AS x, {_COS} AS score, a.ID FROM kb a, kb b WHERE b.ID = 7 ORDER BY score DESC, a.ID LIMIT 5)
SELECT DISTINCT 'github' AS platform, 'commits' AS table_name, AUTHOR_LOGIN AS identity FROM commits WHERE 0 IN (SELECT x FROM top) UNION ALL SELECT DISTINCT 'jira', 'issues', REPORTER_ACCOUNT_ID FROM issues WHERE STATUS_NAME = 'O' AND 1 IN (SELECT x FROM top)""", "kb", "commits", "issues"),
    "vector_topk": with_sql(f"SELECT a.ID, a.LABEL, {_COS} AS score FROM kb a, kb b WHERE b.ID = 7 ORDER BY score DESC, a.ID LIMIT 10", "kb"),
    "vector_topk_batch": with_sql(f"WITH p AS (SELECT b.ID AS QUERY_ID, a.ID, {_COS} AS score FROM kb a, kb b WHERE b.ID % 50 = 0) SELECT QUERY_ID, ID, score, nth FROM (SELECT *, row_number() OVER (PARTITION BY QUERY_ID ORDER BY score DESC, ID) AS nth FROM p) WHERE nth <= 5", "kb"),
    "kb_metadata_filter": with_sql("SELECT ID, LABEL, TABLE_NAME FROM kb WHERE LABEL = 1 AND TABLE_NAME = 'table_1'", "kb"),
}
