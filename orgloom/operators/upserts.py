"""Write modes of keyed tables, as joins of the old and the new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("nth_row", F.row_number().over(w)).filter("nth_row = 1").drop("nth_row")


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of ``new`` whose key is not there yet are added, the first of each key."""
    return old.unionByName(first_by(new, keys, order).join(old, keys, "left_anti").select(*old.columns))


def overwrite(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of ``new`` take the place of those of the same key. If keys of ``new`` repeat, the first in ``order`` counts (give it newest first: the last write wins); without an order they must not."""
    new = first_by(new, keys, order) if order else new
    return old.join(new, keys, "left_anti").unionByName(new.select(*old.columns))


def merge(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """Full outer join by key. rules: of each other column 'new' (overwrite), 'fill_new' (unless null), 'fill_old' (only if null), 'old' (keep for known keys) or 'union' (of arrays)."""
    o = old.select(*[F.col(k) for k in keys], F.lit(True).alias("was_there"), *[F.col(c).alias(f"old_{c}") for c in rules])
    n = new.select(*[F.col(k) for k in keys], F.lit(True).alias("is_new"), *[F.col(c).alias(f"new_{c}") for c in rules])
    both = o.join(n, keys, "full")

    def cell(c: str, rule: str) -> Column:
        a, b = F.col(f"old_{c}"), F.col(f"new_{c}")
        if rule == "new":
            return F.when(F.col("is_new"), b).otherwise(a)
        if rule == "old":
            return F.when(F.col("was_there"), a).otherwise(b)
        if rule == "fill_new":
            return F.coalesce(b, a)
        if rule == "fill_old":
            return F.coalesce(a, b)
        empty = F.array().cast(old.schema[c].dataType)
        return F.array_distinct(F.concat(F.coalesce(a, empty), F.coalesce(b, empty)))

    return both.select(*keys, *[cell(c, r).alias(c) for c, r in rules.items()])


def delete_then_insert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the keys of ``new`` go, whatever their number, and those of ``new`` come."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.select(*old.columns))


def add_column(df: DataFrame, name: str, kind: str = "string") -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))
