"""Descriptions of nested fields: objects, arrays and patterns within each other, as deep as they go.

A column's type details are JSON; what is inside is again such details. One step takes the fields of one level apart, and is
repeated on what it has found until nothing is left, so no depth is built in. Fields are rows; a column's text is made of
them in their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.adapters import load
from ..sources.scratch import written

_FIELD = "struct<name:string,description:string,type_details:string>"
#: What is inside stays text until its turn comes.
DETAILS = f"type string, object_properties array<{_FIELD}>, array_item_schema string, pattern_properties struct<pattern:string,description:string,type_details:string>"
ITEM = "type string, description string, type_details string"
NOTHING = "No description available."
#: Levels after which details that never end are an error.
MOST_LEVELS = 200


def _children(d: Column, item: Column, items: Column) -> Column:
    """Of parsed details: fields of an object in their order, the item of an array, and a pattern, which comes last."""
    child = lambda kind, name, description, details: F.struct(F.lit(kind).alias("role"), name.alias("name"), description.alias("description"), details.alias("details"))
    fields = F.transform(F.coalesce(d["object_properties"], F.array().cast(f"array<{_FIELD}>")), lambda p: child("field", p["name"], p["description"], p["type_details"]))
    # An item says what it is itself, unless it has details of its own.
    of_item = F.when(items.isNotNull(), F.array(child("item", F.lit("[]"), item["description"], F.coalesce(item["type_details"], items))))
    p = d["pattern_properties"]
    of_pattern = F.when(p.isNotNull(), F.array(child("pattern", F.concat(F.lit("<"), p["pattern"], F.lit(">")), p["description"], p["type_details"])))
    none = F.filter(fields, lambda x: F.lit(False))
    return F.concat(fields, F.coalesce(of_item, none), F.coalesce(of_pattern, none))


def fields(columns: DataFrame) -> DataFrame:
    """(table_name, column_name, path, depth, role, kind, description, place) of each field at any depth of ``columns`` (table_name, column_name, type_details).

    The column itself is depth 0. ``place`` sorts a column's fields in the order of the text. Details that are null, no JSON object or of no type have
    a null kind and nothing inside. Details that go on for more than MOST_LEVELS levels are an error."""
    level = columns.select("table_name", "column_name", F.lit("").alias("path"), F.lit("column").alias("role"), F.lit(None).cast("string").alias("description"), F.lit("").alias("place"), F.col("type_details").alias("details"))
    found = []
    for depth in range(MOST_LEVELS + 1):
        parsed = level.withColumn("d", F.from_json("details", DETAILS)).withColumn("items", F.col("d.array_item_schema")).withColumn("item", F.from_json("items", ITEM))
        known = written(parsed.select("*", F.lit(depth).cast("long").alias("depth"), F.col("d.type").alias("kind"), _children(F.col("d"), F.col("item"), F.col("items")).alias("inside")).drop("d", "items", "item", "details"), "fields")
        found.append(known.drop("inside"))
        inside = known.filter(F.size("inside") > 0)
        if inside.isEmpty():
            return reduce(DataFrame.unionByName, found).select("table_name", "column_name", "path", "depth", "role", "kind", "description", "place")
        next_of = inside.select("table_name", "column_name", "path", "place", F.posexplode("inside").alias("at", "c"))
        step = F.when((F.col("c.role") == "field") & (F.col("path") != ""), F.concat(F.lit("."), F.col("c.name"))).otherwise(F.col("c.name"))
        nth = F.lpad((F.col("at") + 1).cast("string"), 6, "0")
        level = next_of.select("table_name", "column_name", F.concat("path", F.coalesce(step, F.lit(""))).alias("path"), "c.role", "c.description", F.concat_ws(".", F.nullif("place", F.lit("")), nth).alias("place"), "c.details")
    raise ValueError(f"details go on for more than {MOST_LEVELS} levels")


def documents(found: DataFrame) -> DataFrame:
    """(table_name, column_name, document): the fields of a column as indented lines, in their order."""
    kind = F.coalesce(F.concat(F.lit(" ("), F.col("kind"), F.lit(")")), F.lit(""))
    name = F.when(F.col("role") == "column", F.col("column_name")).otherwise(F.col("path"))
    said = F.when(F.col("role") == "column", F.lit("")).otherwise(F.concat(F.lit(": "), F.coalesce("description", F.lit(NOTHING))))
    line = F.concat(F.repeat(F.lit("  "), F.col("depth").cast("int")), name, kind, said)
    lines = found.select("table_name", "column_name", F.struct("place", line.alias("line")).alias("l"))
    return lines.groupBy("table_name", "column_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n").alias("document"))


#: Nested details from the parts table, four levels deep in two of three rows; Spark and DuckDB both take it.
_DOCS = """SELECT 'part_' || CAST(p_partkey AS STRING) AS table_name, 'c' || CAST(p_size AS STRING) AS column_name, CASE p_partkey % 3 WHEN 0 THEN NULLIF('{"type": "string"}', CASE WHEN p_partkey % 2 = 0 THEN '{"type": "string"}' END)
ELSE '{"type": "object", "object_properties": [{"name": "brand", "description": "' || p_brand || '"}, {"name": "boxes", "description": "of ' || p_name || '", "type_details": {"type": "array", "array_item_schema": {"type": "object", "description": "a box", "object_properties": [{"name": "labels", "description": "by language", "type_details": {"type": "object", "pattern_properties": {"pattern": ".+", "description": "texts", "type_details": {"type": "array", "array_item_schema": {"type": "string"}}}}}, {"name": "size", "description": "' || CAST(p_size AS STRING) || '", "type_details": {"type": "integer"}}]}}}, {"name": "other"}]' ||
CASE WHEN p_partkey % 3 = 1 THEN ', "pattern_properties": {"pattern": "x_", "description": "extras"}}' ELSE '}' END END AS type_details FROM part"""


def _columns(s: SparkSession, d: str) -> DataFrame:
    load(s, d, "part").createOrReplaceTempView("orgloom_nested_part")
    return s.sql(_DOCS.replace("FROM part", "FROM orgloom_nested_part"))


QUERIES = {
    "nested_fields": lambda s, d: fields(_columns(s, d)),
    "nested_documents": lambda s, d: documents(fields(_columns(s, d))),
}
_TEXT = "json_extract_string({0}, '$.{1}')"
_PART = "CASE WHEN json_extract({0}, '$.{1}') IS NOT NULL AND json_type({0}, '$.{1}') <> 'NULL' THEN CAST(json_extract({0}, '$.{1}') AS VARCHAR) END"
_WALK = f"""WITH RECURSIVE docs AS ({_DOCS}),
w AS (
  SELECT table_name, column_name, '' AS path, 0::BIGINT AS depth, 'column' AS role, {_TEXT.format("type_details", "type")} AS kind, NULL::VARCHAR AS description, '' AS place, type_details AS details FROM docs
  UNION ALL
  SELECT w.table_name, w.column_name, w.path || CASE WHEN c.role = 'field' AND w.path <> '' THEN '.' ELSE '' END || coalesce(c.name, ''), w.depth + 1, c.role, json_extract_string(c.details, '$.type'), c.description,
         CASE WHEN w.place = '' THEN '' ELSE w.place || '.' END || lpad(CAST(c.at AS VARCHAR), 6, '0'), c.details
  FROM w, LATERAL (
    SELECT i AS at, 'field' AS role, json_extract_string(w.details, '$.object_properties[' || (i - 1) || '].name') AS name, json_extract_string(w.details, '$.object_properties[' || (i - 1) || '].description') AS description, CAST(json_extract(w.details, '$.object_properties[' || (i - 1) || '].type_details') AS VARCHAR) AS details
    FROM range(1, coalesce(json_array_length(w.details, '$.object_properties'), 0)::BIGINT + 1) t(i)
    UNION ALL SELECT coalesce(json_array_length(w.details, '$.object_properties'), 0) + 1, 'item', '[]', {_TEXT.format("w.details", "array_item_schema.description")}, coalesce({_PART.format("w.details", "array_item_schema.type_details")}, {_PART.format("w.details", "array_item_schema")}) WHERE json_extract(w.details, '$.array_item_schema') IS NOT NULL
    UNION ALL SELECT coalesce(json_array_length(w.details, '$.object_properties'), 0) + 1, 'pattern', '<' || {_TEXT.format("w.details", "pattern_properties.pattern")} || '>', {_TEXT.format("w.details", "pattern_properties.description")}, {_PART.format("w.details", "pattern_properties.type_details")} WHERE json_extract(w.details, '$.pattern_properties') IS NOT NULL
  ) c)"""
ORACLES = {
    "nested_fields": f"{_WALK} SELECT table_name, column_name, path, depth, role, kind, description, place FROM w",
    "nested_documents": f"""{_WALK} SELECT table_name, column_name, string_agg(repeat('  ', depth) || CASE WHEN role = 'column' THEN column_name ELSE path END || coalesce(' (' || kind || ')', '') || CASE WHEN role = 'column' THEN '' ELSE ': ' || coalesce(description, '{NOTHING}') END, chr(10) ORDER BY place) AS document
FROM w GROUP BY table_name, column_name""",
}
