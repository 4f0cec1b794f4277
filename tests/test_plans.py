"""Predicate trees of plans against their own SQL, and nested details of any depth."""

import json
import random

import duckdb
import pytest

from orgloom.plans import compiler, nested
from orgloom.plans.compiler import All, ColumnSelection, Compare, Missing, Not, OneOf, Some, TargetSchema

ROWS = [(a, b, c) for a in (None, 1, 2, 3) for b in (None, "x", "y'z", 'q"') for c in (None, 0.5, -1.0)]


def tree(r, depth):
    kind = r.choice(["cmp", "in", "null"] if depth == 0 else ["cmp", "in", "null", "and", "or", "not"])
    column, values = r.choice([("a", (1, 2, 9)), ("b", ("x", "y'z", "none")), ("c", (0.5, -1.0))])
    if kind == "cmp":
        return Compare(column, "LIKE", "%'%") if column == "b" and r.random() < 0.3 else Compare(column, r.choice(["=", "<>", "<", "<=", ">", ">="]), r.choice(values))
    if kind == "in":
        return OneOf(column, tuple(r.sample(values, r.randrange(len(values) + 1))))
    if kind == "null":
        return Missing(column, r.random() < 0.5)
    if kind == "not":
        return Not(tree(r, depth - 1))
    return (All if kind == "and" else Some)(tuple(tree(r, depth - 1) for _ in range(r.randrange(4))))


def test_generated_plans_give_the_rows_of_their_sql(spark):
    df = spark.createDataFrame(ROWS, "a int, b string, c double")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a INT, b VARCHAR, c DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", ROWS)
    r = random.Random(4)
    for n in range(40):
        hints = r.choice(["", "distinct", "ORDER BY b desc, k limit 7", "distinct rows, order by k asc LIMIT 5", "limit 4"])
        t = TargetSchema("p", "t", [ColumnSelection("a", "k"), ColumnSelection("b"), *([ColumnSelection("c", "v")] if n % 2 else [])], tree(r, 3), hints)
        got, want = [tuple(x) for x in compiler.compile_target(df, t).collect()], con.execute(compiler.to_sql(t)).fetchall()
        assert (got == want) if "limit" in hints.lower() else (sorted(map(repr, got)) == sorted(map(repr, want))), (t, compiler.to_sql(t))


def test_plans_are_checked(spark):
    df = spark.createDataFrame(ROWS, "a int, b string, c double")
    ok = [ColumnSelection("a")]
    for bad in (
        TargetSchema("p", "t", [ColumnSelection("z")]), TargetSchema("p", "t", []), TargetSchema("p", "t", [ColumnSelection("a"), ColumnSelection("b", "A")]), TargetSchema("p", "t", ok, Not(All((Missing("z"),)))),
        TargetSchema("p", "t", ok, Compare("a", "==", 1)), TargetSchema("p", "t", ok, None, "order by z"), TargetSchema("p", "t", ok, None, "order by a; drop table t"),
    ):
        with pytest.raises(ValueError):
            compiler.compile_target(df, bad)
            compiler.to_sql(bad)
            raise AssertionError(bad)
    with pytest.raises(TypeError):
        compiler.compile_target(df, TargetSchema("p", "t", ok, Not(("a",))))


def walk(details, path, depth, role, description):
    """Recursion in plain Python: (path, depth, role, kind, description) in the order of the text."""
    d = details if isinstance(details, dict) else {}
    out = [(path, depth, role, d.get("type"), description)]
    for p in d.get("object_properties") or []:
        out += walk(p.get("type_details"), f"{path}.{p['name']}" if path else p["name"], depth + 1, "field", p.get("description"))
    if (item := d.get("array_item_schema")) is not None:
        out += walk(item.get("type_details") or item, f"{path}[]", depth + 1, "item", item.get("description"))
    if (pp := d.get("pattern_properties")) is not None:
        out += walk(pp.get("type_details"), f"{path}<{pp['pattern']}>", depth + 1, "pattern", pp.get("description"))
    return out


def details(r, depth):
    kind = r.choice(["object", "array", "string", "pattern"] if depth else ["string", "integer"])
    if kind == "object":
        return {"type": "object", "object_properties": [{"name": f"f{i}", **({"description": f"d {r.random()}"} if r.random() < 0.7 else {}), **({"type_details": details(r, depth - 1)} if r.random() < 0.8 else {})} for i in range(r.randrange(1, 12))]}
    if kind == "array":
        own = details(r, depth - 1)
        return {"type": "array", "array_item_schema": own | {"description": "items"} if r.random() < 0.5 else {"type": "object", "type_details": own}}
    if kind == "pattern":
        return {"type": "object", "pattern_properties": {"pattern": ".+", "description": "any", "type_details": details(r, depth - 1)}}
    return {"type": kind}


def test_nested_details_of_any_depth(spark):
    r = random.Random(2)
    docs = [("t", f"c{i}", details(r, 6)) for i in range(12)] + [("t", "none", None)]
    rows = [(t, c, None if d is None else json.dumps(d)) for t, c, d in docs] + [("t", "broken", "not JSON"), ("t", "list", "[1]")]
    found = nested.fields(spark.createDataFrame(rows, "table_name string, column_name string, type_details string"))
    got = {}
    for x in sorted(found.collect(), key=lambda x: (x["column_name"], x["place"])):
        got.setdefault(x["column_name"], []).append((x["path"], x["depth"], x["role"], x["kind"], x["description"]))
    want = {c: walk(d, "", 0, "column", None) for _, c, d in docs} | {c: [("", 0, "column", None, None)] for c in ("broken", "list")}
    assert got == want and max(d for v in want.values() for _, d, *_ in v) >= 5
    text = {x["column_name"]: x["document"] for x in nested.documents(found).collect()}
    assert len(text) == len(want) and text["none"] == "none"
    for c, lines in want.items():
        assert [x.strip().split(" ")[0].rstrip(":") for x in text[c].split("\n")] == [p or c for p, *_ in lines]


def test_a_hot_key_is_many_parts(spark, monkeypatch):
    """Commits and pull requests of one key give all their pairs, from several parts; keys of one side alone, repeated stories and nulls too."""
    from orgloom.plans import links

    monkeypatch.setattr(links, "PAIRS_OF_PART", 50)
    issues = spark.createDataFrame([("ORD-1", "Story", "Epic", "E1"), ("ORD-1", "Story", None, None), ("ORD-2", "Story", "Epic", "E2"), ("ORD-3", "Story", "Epic", "E3"), ("ORD-4", "Task", "Epic", "E3"), ("ORD-5", "Story", "Epic", "E5"), (None, "Story", "Epic", "E6")], "ISSUE_KEY string, ISSUE_TYPE string, PARENT_ISSUE_TYPE string, PARENT_ID string")
    commits = spark.createDataFrame([(f"c{i}", f"fix ORD-{1 if i < 60 else i % 5}") for i in range(80)] + [("none", None), ("two", "ORD-2"), ("two", "ORD-2")], "COMMIT_SHA string, COMMIT_MESSAGE string").filter("coalesce(COMMIT_MESSAGE, '') NOT LIKE '%ORD-3'")
    prs = spark.createDataFrame([(f"p{i}", "AUTHOR", f"ORD-{1 if i < 30 else 3}", None) for i in range(40)], "INTERNAL_ID string, ROLE_IN_PR string, TITLE string, BODY string")
    got = sorted(map(str, links.story_links(issues, commits, prs).collect()))
    stories, c, p = ([tuple(r) for r in df.collect()] for df in links.named_by(issues, commits, prs))
    want = []
    for key, epic in stories:
        mine, theirs = [x[1] for x in c if x[0] == key], [x[1:] for x in p if x[0] == key]
        if mine or theirs:
            want += [(key, epic, sha, *pull) for sha in mine or [None] for pull in theirs or [(None, None)]]
    rows = links.story_links(issues, commits, prs).schema
    assert got == sorted(str(r) for r in spark.createDataFrame(want, rows).collect()) and len(want) > 3600
    counts = {(r["ISSUE_KEY"], r["EPIC_ID"]): r["links"] for r in links.story_link_counts(issues, commits, prs).collect()}
    assert sum(counts.values()) == len(want)
