"""Files, folders and catalogs: scans, exports and write modes, each carried out on tables that live for a while."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import upserts
from ..sources import catalog
from ..sources.adapters import load, with_sql
from ..sources.scratch import scratch_dir
from . import graph


def load_schemas(spark: SparkSession, folder: str, schemas: dict[str, list[str]]) -> dict[str, DataFrame]:
    """'schema.table' -> its rows, of CSV files below folder/schema/table, with inferred types."""
    return {f"{schema}.{table}": catalog.open_source(spark, "csv", path=f"{folder}/{schema}/{table}") for schema, tables in schemas.items() for table in tables}


def export_tables(spark: SparkSession, database: str, folder: str) -> list[str]:
    """Writes every table of a database below ``folder`` as CSV with a header; the names, in order."""
    names = [r["table_name"] for r in catalog.list_tables(spark).filter(F.col("schema_name") == database).orderBy("table_name").collect()]
    for name in names:
        catalog.export_csv(spark.table(f"{database}.{name}"), f"{folder}/{database}/{name}")
    return names


def in_database(spark: SparkSession, tables: dict[str, DataFrame], use: Callable[[str], DataFrame]) -> DataFrame:
    """``use`` of a new database that has these tables; its rows are written, and the database is dropped again."""
    name, folder = f"orgloom_{uuid.uuid4().hex}", scratch_dir(spark, "database")
    fresh_database(spark, name, folder)
    try:
        for table, df in tables.items():
            df.write.mode("overwrite").saveAsTable(f"{name}.{table}")
        found = use(name)
        out = scratch_dir(spark, "rows")
        found.write.parquet(out)
        return spark.read.schema(found.schema).parquet(out)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def fresh_database(spark: SparkSession, name: str, folder: str | None = None) -> None:
    """An empty database of that name, whatever was there."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}" + (f" LOCATION '{folder}'" if folder else ""))


def _schema_scan(s: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(s, "csv")
    for schema, table in (("geo", "region"), ("geo", "nation"), ("people", "supplier")):
        catalog.export_csv(load(s, d, table), f"{folder}/{schema}/{table}")
    found = load_schemas(s, folder, {"geo": ["region", "nation"], "people": ["supplier"]})
    nation, region = found["geo.nation"], found["geo.region"]
    met = nation.join(region, nation.n_regionkey == region.r_regionkey).join(found["people.supplier"], nation.n_nationkey == F.col("s_nationkey"))
    return met.groupBy("r_name").agg(F.count(F.lit(1)).alias("suppliers"), F.max("s_suppkey").cast("bigint").alias("last_key"))


def _pick_rename(s: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(s, "csv")
    catalog.export_csv(load(s, d, "accounts").select(F.col("ACCOUNT_ID").alias("User id"), F.col("DISPLAY_NAME").alias("User name"), F.col("ACTIVE").alias("Extra")), folder)
    return catalog.open_source(s, "csv", path=folder, schema="`User id` string, `User name` string, Extra boolean", columns={"User id": "ID", "User name": "DISPLAY_NAME"})


def _exported(s: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(s, "export")

    def use(name: str) -> DataFrame:
        export_tables(s, name, folder)
        return catalog.list_tables(s).filter(F.col("schema_name") == name).select("table_name").join(s.createDataFrame([(t, s.read.option("header", True).csv(f"{folder}/{name}/{t}").count()) for t in ("nation", "region")], "table_name string, n long"), "table_name")

    return in_database(s, {"region": load(s, d, "region"), "nation": load(s, d, "nation")}, use)


def _existence(s: SparkSession, d: str) -> DataFrame:
    """A table for each status of orders; for each flag and status of their items, whether there is one of that name."""
    orders, items = load(s, d, "orders"), load(s, d, "lineitem")
    made = {f"of_{r[0].lower()}": orders.filter(F.col("o_orderstatus") == r[0]).select("o_orderkey") for r in orders.select("o_orderstatus").distinct().collect()}  # three letters
    asked = sorted(f"of_{r[0].lower()}" for r in items.select("l_linestatus").union(items.select("l_returnflag")).distinct().collect())
    return in_database(s, made, lambda name: s.createDataFrame([(t, catalog.has_table(s, f"{name}.{t}")) for t in asked], "table_name string, there boolean"))


def _fresh(s: SparkSession, d: str) -> DataFrame:
    """The rows of a database's tables, and whether they are there once it is made afresh, with one of them written anew."""

    def use(name: str) -> DataFrame:
        before = {t.name: s.table(f"{name}.{t.name}").count() for t in s.catalog.listTables(name)}
        fresh_database(s, name, scratch_dir(s, "database"))
        load(s, d, "nation").filter("n_regionkey = 1").write.saveAsTable(f"{name}.nation")
        after = {t.name: s.table(f"{name}.{t.name}").count() for t in s.catalog.listTables(name)}
        return s.createDataFrame([(t, n, after.get(t)) for t, n in before.items()], "table_name string, before long, after long")

    return in_database(s, {n: load(s, d, n) for n in ("region", "nation", "supplier")}, use)


def _counted_write(s: SparkSession, d: str) -> DataFrame:
    folder, rows = scratch_dir(s, "counted"), []
    for step, condition in enumerate(("event_id % 2 = 0", "event_id % 4 = 1", "false")):
        rows.append((step, *catalog.counted_write(load(s, d, "events").filter(condition).select("event_id"), folder)))
    return s.createDataFrame(rows, "step long, before long, after long")


def _replaced(s: SparkSession, d: str) -> DataFrame:
    """Written, and replaced by other rows: only those are left."""
    folder = scratch_dir(s, "replaced")
    load(s, d, "orders").filter("o_orderstatus = 'O'").select("o_orderkey").write.mode("overwrite").parquet(folder)
    load(s, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey").write.mode("overwrite").parquet(folder)
    return s.read.parquet(folder)


def _first_rows(s: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(s, "first")
    catalog.export_csv(load(s, d, "supplier").select("s_suppkey", "s_name"), folder, first=7, order=["s_suppkey"])
    return s.read.schema("s_suppkey long, s_name string").option("header", True).csv(folder)


def _json_round(s: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(s, "json")
    catalog.export_json(load(s, d, "nation").select("n_nationkey", F.struct("n_name", F.array("n_regionkey").alias("regions")).alias("nested")), folder)
    found = catalog.open_source(s, "json", path=folder, schema="n_nationkey long, nested struct<n_name:string,regions:array<bigint>>")
    return found.select("n_nationkey", "nested.n_name", F.col("nested.regions")[0].alias("region"))


def saved_outputs(s: SparkSession, folder: str) -> DataFrame:
    """(goal, platform) of saved answers: JSON over several lines, an object or a list of them in a file; an answer without rows has a null platform."""
    found = catalog.open_source(s, "json", path=folder, schema="goal string, rows array<struct<platform:string>>", multi_line=True)
    return found.select("goal", F.explode_outer("rows").alias("r")).select("goal", "r.platform")


def _saved(s: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(s, "saved")
    answer = F.expr("""'{\n  "goal": "' || n_name || '",\n  "rows": ' || CASE WHEN n_nationkey % 3 = 0 THEN '[]' ELSE '[{"platform": "github"}, {"platform": "jira"}]' END || '\n}'""")
    whole = load(s, d, "nation").agg(F.concat(F.lit("[\n"), F.array_join(F.sort_array(F.collect_list(answer)), ",\n"), F.lit("\n]")).alias("value"))
    whole.coalesce(1).write.text(folder)
    return saved_outputs(s, folder)


def _graph(s: SparkSession, d: str) -> DataFrame:
    """Vertices and edges written, read again, and written over: keys that are there are skipped, and counts of known edges are set anew."""
    names = ("commits", "prs", "issues", "matched", "skills")
    vertices, edges = graph.vertices(*[load(s, d, n) for n in names]), graph.epic_edges(load(s, d, "issues"))
    folder = scratch_dir(s, "graph")
    for _ in range(2):
        catalog.export_graph(vertices, edges, folder)
    there = s.read.parquet(f"{folder}/vertices").select("kind", "key", "title")
    again = upserts.insert_ignore(there, vertices, ["kind", "key"], [F.asc_nulls_last("title")])
    arrows = s.read.parquet(f"{folder}/edges").select("kind", F.concat_ws(" > ", "src", "dst").alias("key"), F.lit(None).cast("string").alias("title"))
    return again.select("kind", "key", "title").unionByName(arrows)


def _edge_update(s: SparkSession, d: str) -> DataFrame:
    """Edges of one half of the issues, and then those of all: known edges get the new count, others are added."""
    made = lambda rows: graph.epic_collaboration(rows, load(s, d, "matched")).select(F.concat_ws("-", "epic1", "epic2").alias("_key"), "shared_count")
    issues = load(s, d, "issues")
    return upserts.overwrite(made(issues.filter("STATUS_NAME = 'O'")), made(issues), ["_key"])


def _delete_all(s: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(s, "emptied")
    users = load(s, d, "accounts").filter("ACCOUNT_ID IS NOT NULL")
    for condition in ("ACTIVE", "NOT ACTIVE"):
        users.filter(condition).select("ACCOUNT_ID").write.mode("overwrite").parquet(folder)
    return s.read.parquet(folder)


def _tuple_delete(s: SparkSession, d: str) -> DataFrame:
    """All rows of each (user, type) of the new rows go, however many they are, and the new ones come."""
    e = load(s, d, "events")
    old = e.select("user_id", "event_type", F.col("event_id").alias("n"))
    new = e.filter("event_type IN ('click', 'view') AND user_id % 3 = 0").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return upserts.delete_then_insert(old, new, ["user_id", "event_type"])


def _vectors(s: SparkSession, d: str) -> DataFrame:
    """The vector collection upserted by id: known ids get the new text and vector."""
    kb = load(s, d, "kb").select("ID", F.concat(F.lit("old "), "TABLE_NAME").alias("DOCUMENT"), "LABEL", "EMBEDDING")
    new = kb.filter("LABEL = 1").select("ID", F.concat(F.lit("new "), F.col("ID").cast("string")).alias("DOCUMENT"), (F.col("LABEL") + 10).alias("LABEL"), F.reverse("EMBEDDING").alias("EMBEDDING"))
    places = F.zip_with("EMBEDDING", F.sequence(F.lit(1), F.size("EMBEDDING")), lambda x, i: x.cast("double") * i)
    mark = F.round(F.aggregate(places, F.lit(0.0), lambda a, x: a + x), 4)
    return upserts.overwrite(kb.filter("LABEL < 3"), new, ["ID"]).select("ID", "DOCUMENT", F.col("LABEL").cast("bigint").alias("LABEL"), F.size("EMBEDDING").cast("bigint").alias("width"), mark.alias("mark"))


def _sheet(s: SparkSession, d: str) -> DataFrame:
    """The columns of a table as they are, one more that all get, and one that is added only if it is missing."""
    rows = upserts.add_column(upserts.add_column(load(s, d, "nation"), "n_name"), "INFERENCE_INPUT")
    return catalog.columns_of({"sheet": rows}).select("ordinal", "column_name", "column_type")


def _view(s: SparkSession, d: str) -> DataFrame:
    name = f"tmp_{uuid.uuid4().hex}"
    load(s, d, "supplier").createOrReplaceTempView(name)
    out = s.sql(f"SELECT s_nationkey, count(*) AS n FROM {name} GROUP BY s_nationkey")
    out.schema  # the plan holds the rows from here on  # noqa: B018
    s.catalog.dropTempView(name)
    return out


QUERIES = {
    "csv_schemas": _schema_scan, "csv_pick_rename": _pick_rename, "export_all": _exported, "table_exists": _existence, "fresh_database": _fresh, "counted_write": _counted_write, "replace_table": _replaced,
    "export_first_rows": _first_rows, "json_export": _json_round, "saved_outputs": _saved, "graph_export": _graph, "edge_update": _edge_update, "delete_all_insert": _delete_all, "delete_tuples_insert": _tuple_delete,
    "vector_upsert": _vectors, "added_columns": _sheet, "registered_relation": _view,
    "source_registry": lambda s, d: catalog.open_source(s, "parquet", path=f"{d}/region.parquet"),
}


ORACLES = {
    "csv_schemas": "SELECT r_name, count(*) AS suppliers, max(s_suppkey)::BIGINT AS last_key FROM nation JOIN region ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey GROUP BY r_name",
    "csv_pick_rename": with_sql("SELECT ACCOUNT_ID AS ID, DISPLAY_NAME FROM accounts", "accounts"),
    "export_all": "SELECT 'nation' AS table_name, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region",
    "table_exists": "SELECT 'of_' || lower(x) AS table_name, x IN (SELECT o_orderstatus FROM orders) AS there FROM (SELECT l_linestatus AS x FROM lineitem UNION SELECT l_returnflag FROM lineitem)",
    "fresh_database": "SELECT 'region' AS table_name, count(*) AS before, NULL::BIGINT AS after FROM region UNION ALL SELECT 'nation', count(*), count(*) FILTER (n_regionkey = 1) FROM nation UNION ALL SELECT 'supplier', count(*), NULL FROM supplier",
    "counted_write": "WITH n AS (SELECT count(*) FILTER (event_id % 2 = 0) AS a, count(*) FILTER (event_id % 4 = 1) AS b FROM events) SELECT 0::BIGINT AS step, 0::BIGINT AS before, a AS after FROM n UNION ALL SELECT 1, a, a + b FROM n UNION ALL SELECT 2, a + b, a + b FROM n",
    "replace_table": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    "export_first_rows": "SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 7",
    "json_export": "SELECT n_nationkey, n_name, n_regionkey AS region FROM nation",
    "saved_outputs": "SELECT n_name AS goal, unnest(['github', 'jira']) AS platform FROM nation WHERE n_nationkey % 3 <> 0 UNION ALL SELECT n_name, NULL FROM nation WHERE n_nationkey % 3 = 0",
    "graph_export": f"SELECT kind, key, title FROM ({graph.ORACLES['graph_vertices']}) UNION ALL SELECT kind, src || ' > ' || dst, NULL FROM ({graph.ORACLES['epic_edges']})",
    "edge_update": f"SELECT epic1 || '-' || epic2 AS _key, shared_count FROM ({graph.ORACLES['epic_collaboration']})",
    "added_columns": "SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS ordinal, column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS column_type FROM (DESCRIBE nation) UNION ALL SELECT count(*), 'INFERENCE_INPUT', 'string' FROM (DESCRIBE nation)",
    "delete_all_insert": with_sql("SELECT ACCOUNT_ID FROM accounts WHERE ACCOUNT_ID IS NOT NULL AND NOT ACTIVE", "accounts"),
    "delete_tuples_insert": "WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view') AND user_id % 3 = 0 GROUP BY ALL) SELECT user_id, event_type, event_id AS n FROM events WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM n) UNION ALL SELECT * FROM n",
    "vector_upsert": with_sql("SELECT ID, 'old ' || TABLE_NAME AS DOCUMENT, LABEL::BIGINT AS LABEL, len(EMBEDDING)::BIGINT AS width, round(list_inner_product(EMBEDDING::DOUBLE[], range(1, len(EMBEDDING) + 1)::DOUBLE[]), 4) AS mark FROM kb WHERE LABEL < 3 AND LABEL <> 1 UNION ALL SELECT ID, 'new ' || CAST(ID AS VARCHAR), 11, len(EMBEDDING), round(list_inner_product(list_reverse(EMBEDDING)::DOUBLE[], range(1, len(EMBEDDING) + 1)::DOUBLE[]), 4) FROM kb WHERE LABEL = 1", "kb"),
    "registered_relation": "SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey",
    "source_registry": "SELECT * FROM region",
}
