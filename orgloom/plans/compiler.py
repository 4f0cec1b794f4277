"""From a selection plan (what to read, under what names, with what limits) to a DataFrame."""

from __future__ import annotations

import operator
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.adapters import load, with_sql


@dataclass(frozen=True)
class ColumnSelection:
    source: str
    alias: str | None = None


@dataclass(frozen=True)
class Compare:
    """A column against a literal: = <> < <= > >=, or LIKE."""

    column: str
    op: str
    value: str | int | float | bool


@dataclass(frozen=True)
class OneOf:
    """IN; no value means no row."""

    column: str
    values: tuple


@dataclass(frozen=True)
class Missing:
    """IS NULL, or IS NOT NULL."""

    column: str
    missing: bool = True


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Some:
    parts: tuple


@dataclass(frozen=True)
class Not:
    part: object


@dataclass(frozen=True)
class TargetSchema:
    """Columns of one table; ``where`` is a tree of the above, or SQL text that Spark checks.

    hints are words like 'distinct', 'limit 10' or 'ORDER BY a DESC, b'."""

    platform: str
    table: str
    columns: list[ColumnSelection]
    where: object = None
    hints: str = ""


@dataclass(frozen=True)
class Plan:
    targets: list[TargetSchema] = field(default_factory=list)


_OPS = {"=": operator.eq, "<>": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def predicate(tree: object) -> Column:
    """The tree as a condition, with SQL's rules for nulls."""
    if isinstance(tree, Compare):
        if tree.op == "LIKE":
            return F.col(tree.column).like(str(tree.value))
        if tree.op not in _OPS:
            raise ValueError(f"unknown operator {tree.op!r}")
        return _OPS[tree.op](F.col(tree.column), F.lit(tree.value))
    if isinstance(tree, OneOf):
        return F.col(tree.column).isin(*tree.values) if tree.values else F.lit(False)
    if isinstance(tree, Missing):
        return F.col(tree.column).isNull() if tree.missing else F.col(tree.column).isNotNull()
    if isinstance(tree, All):
        return reduce(operator.and_, map(predicate, tree.parts), F.lit(True))
    if isinstance(tree, Some):
        return reduce(operator.or_, map(predicate, tree.parts), F.lit(False))
    if isinstance(tree, Not):
        return ~predicate(tree.part)
    raise TypeError(f"no predicate: {tree!r}")


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _literal(value: object) -> str:
    if isinstance(value, bool):
        return str(value).upper()
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def predicate_sql(tree: object) -> str:
    """The same as SQL text."""
    if isinstance(tree, Compare):
        if tree.op not in (*_OPS, "LIKE"):
            raise ValueError(f"unknown operator {tree.op!r}")
        return f"{_quoted(tree.column)} {tree.op} {_literal(tree.value)}"
    if isinstance(tree, OneOf):
        return f"{_quoted(tree.column)} IN ({', '.join(map(_literal, tree.values))})" if tree.values else "FALSE"
    if isinstance(tree, Missing):
        return f"{_quoted(tree.column)} IS {'' if tree.missing else 'NOT '}NULL"
    if isinstance(tree, (All, Some)):
        empty, word = ("TRUE", " AND ") if isinstance(tree, All) else ("FALSE", " OR ")
        return "(" + (word.join(map(predicate_sql, tree.parts)) or empty) + ")"
    if isinstance(tree, Not):
        return f"NOT ({predicate_sql(tree.part)})"
    raise TypeError(f"no predicate: {tree!r}")


def columns_of(tree: object) -> set[str]:
    """The columns that a tree reads."""
    if isinstance(tree, (All, Some)):
        return set().union(*map(columns_of, tree.parts))
    if isinstance(tree, Not):
        return columns_of(tree.part)
    if tree is None or isinstance(tree, str):
        return set()
    if isinstance(tree, (Compare, OneOf, Missing)):
        return {tree.column}
    raise TypeError(f"no predicate: {tree!r}")


def order_of(target: TargetSchema) -> list[tuple[str, bool]]:
    """(column, descending) of the hint ORDER BY, by alias or source; nothing else in it is understood."""
    found = re.search(r"\border\s+by\s+(.+?)(?=\s*(?:\blimit\b|\bdistinct\b|$))", target.hints, re.IGNORECASE | re.DOTALL)
    out = []
    names = {x: c.alias or c.source for c in target.columns for x in (c.source, c.alias) if x}
    for part in found[1].split(",") if found else ():
        m = re.fullmatch(r'\s*"?(\w+)"?(?:\s+(asc|desc))?\s*', part, re.IGNORECASE)
        if not m or m[1] not in names:
            raise ValueError(f"ORDER BY {part.strip()!r} is no selected column")
        out.append((names[m[1]], (m[2] or "").lower() == "desc"))
    return out


def _limit(target: TargetSchema) -> int | None:
    m = re.search(r"\blimit\s+(\d+)\b", target.hints, re.IGNORECASE)
    return int(m[1]) if m else None


def _order(target: TargetSchema) -> list[tuple[str, bool]]:
    """What is asked for; before a limit all other columns follow, so that which rows are first is certain."""
    asked = order_of(target)
    rest = [n for n in dict.fromkeys(c.alias or c.source for c in target.columns) if n not in {a for a, _ in asked}]
    return asked + [(n, False) for n in rest] if _limit(target) is not None else asked


def check(df: DataFrame, target: TargetSchema) -> None:
    """An error if the target names a column that the table doesn't have, or two columns alike."""
    wanted = {c.source for c in target.columns} | columns_of(target.where)
    if unknown := sorted(wanted - set(df.columns)):
        raise ValueError(f"{target.table} has no {', '.join(unknown)}")
    names = [(c.alias or c.source).lower() for c in target.columns]
    if not names or len(set(names)) < len(names):
        raise ValueError("a target needs columns, each of its own name")


def compile_target(df: DataFrame, target: TargetSchema) -> DataFrame:
    """SELECT [DISTINCT] source AS alias ... [WHERE] [ORDER BY] [LIMIT] on ``df``, whose columns are checked; nulls come last in any order."""
    check(df, target)
    rows = df if target.where is None else df.where(target.where if isinstance(target.where, str) else predicate(target.where))
    rows = rows.select(*[F.col(c.source).alias(c.alias or c.source) for c in target.columns])
    if re.search(r"\bdistinct\b", target.hints, re.IGNORECASE):
        rows = rows.distinct()
    if order := _order(target):
        rows = rows.orderBy(*[F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, down in order])
    return rows if _limit(target) is None else rows.limit(_limit(target))


def to_sql(target: TargetSchema) -> str:
    """The same target as SQL text."""
    distinct = "DISTINCT " if re.search(r"\bdistinct\b", target.hints, re.IGNORECASE) else ""
    listed = ", ".join(f"{_quoted(c.source)} AS {_quoted(c.alias or c.source)}" for c in target.columns)
    where = "" if target.where is None else f" WHERE {target.where if isinstance(target.where, str) else predicate_sql(target.where)}"
    order = ", ".join(f"{_quoted(c)} {'DESC' if down else 'ASC'} NULLS LAST" for c, down in _order(target))
    limit = "" if _limit(target) is None else f" LIMIT {_limit(target)}"
    return f"SELECT {distinct}{listed} FROM {target.table}{where}{f' ORDER BY {order}' if order else ''}{limit}"


def run(spark: SparkSession, plan: Plan, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The rows of a plan by platform, as (table, JSON of the row)."""
    out: dict[str, list[DataFrame]] = {}
    for t in plan.targets:
        rows = compile_target(tables[t.table], t)
        out.setdefault(t.platform, []).append(rows.select(F.lit(t.table).alias("table_name"), F.to_json(F.struct(*rows.columns)).alias("row")))
    return {k: reduce(DataFrame.unionByName, v) for k, v in out.items()}


DISTINCT_PLAN = TargetSchema("github", "commits", [ColumnSelection("AUTHOR_LOGIN", "login"), ColumnSelection("REPO", "repository")], "AUTHOR_EMAIL IS NOT NULL", "distinct rows only")
LIMIT_PLAN = TargetSchema("jira", "issues", [ColumnSelection("ISSUE_KEY", "key"), ColumnSelection("PROJECT_KEY")], "STATUS_NAME = 'O'", "limit 25")

TREE_PLAN = TargetSchema(
    "jira", "issues", [ColumnSelection("ISSUE_KEY", "key"), ColumnSelection("PROJECT_KEY", "project"), ColumnSelection("CREATED_TIMESTAMP", "made")],
    All((Some((OneOf("STATUS_NAME", ("O", "P")), Compare("PROJECT_KEY", "LIKE", "P1%"))), Not(Missing("ASSIGNEE_ACCOUNT_ID")), Compare("ISSUE_TYPE", "<>", "Task"))), "order by made desc, key limit 500",
)


def _both(s: SparkSession, d: str) -> DataFrame:
    found = run(s, Plan([DISTINCT_PLAN, LIMIT_PLAN]), {n: load(s, d, n) for n in ("commits", "issues")})
    return reduce(DataFrame.unionByName, [df.groupBy("table_name").agg(F.count(F.lit(1)).alias("n")).withColumn("platform", F.lit(p)) for p, df in found.items()])


QUERIES = {
    "plan_select": lambda s, d: compile_target(load(s, d, "commits"), DISTINCT_PLAN),
    "plan_limit": lambda s, d: compile_target(load(s, d, "issues"), LIMIT_PLAN),
    "plan_platforms": _both,
    "plan_tree": lambda s, d: compile_target(load(s, d, "issues"), TREE_PLAN),
}
ORACLES = {
    "plan_tree": with_sql(to_sql(TREE_PLAN), "issues"),
    "plan_select": with_sql(to_sql(DISTINCT_PLAN), "commits"),
    "plan_limit": with_sql(to_sql(LIMIT_PLAN), "issues"),
    "plan_platforms": with_sql(f"SELECT 'commits' AS table_name, count(*) AS n, 'github' AS platform FROM ({to_sql(DISTINCT_PLAN)}) UNION ALL SELECT 'issues', count(*), 'jira' FROM ({to_sql(LIMIT_PLAN)})", "commits", "issues"),
}
