"""Joins whose obvious form would be a nested loop, as equi-joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_of(left: DataFrame, keys: list[str], right: DataFrame, right_key: str) -> DataFrame:
    """left ⋈ right where any of ``keys`` equals ``right_key``, once for each pair of rows: keys become one column, then one equi-join."""
    spread = left.withColumn("any_key", F.explode(F.array_distinct(F.filter(F.array(*keys), lambda k: k.isNotNull()))))
    return spread.join(right, F.col("any_key") == right[right_key]).drop("any_key")


def or_left(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], row_id: list[str], keep: list[str]) -> DataFrame:
    """left ⟕ right where any pair of ``on`` is equal: equi-joins, their union without repeats, and the rows of ``left`` without one.

    row_id: columns that tell the rows of ``left`` apart; keep: columns of ``right`` in the result, which tell its rows apart."""
    r = right.select(*[F.col(b).alias(f"or_{b}") for b in {b for _, b in on}], *[F.col(k).alias(f"keep_{k}") for k in keep])
    met = [left.join(r, F.col(a) == F.col(f"or_{b}")).select(*left.columns, *[F.col(f"keep_{k}").alias(k) for k in keep]) for a, b in on]
    met = reduce(DataFrame.unionByName, met).dropDuplicates([*row_id, *keep])
    alone = left.join(met.select(*row_id).distinct(), row_id, "left_anti")
    return met.unionByName(alone, allowMissingColumns=True)


def not_in(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """NOT IN with its rule for nulls: nothing is left if ``right`` has one; then no null key of ``left`` either, unless ``right`` is empty."""
    r = right.select(F.col(right_key).alias("in_key"))
    state = r.agg(F.coalesce(F.max(F.col("in_key").isNull()), F.lit(False)).alias("in_null"), (F.count(F.lit(1)) > 0).alias("in_some"))  # one row
    kept = left.join(r.filter("in_key IS NOT NULL"), F.col(key) == F.col("in_key"), "left_anti").join(F.broadcast(state))
    return kept.filter(~F.col("in_null") & (F.col(key).isNotNull() | ~F.col("in_some"))).drop("in_null", "in_some")


def blocked_pairs(left: DataFrame, right: DataFrame, left_keys: Column, right_keys: Column, ids: tuple[str, str]) -> DataFrame:
    """Pairs that share a block key, once each."""
    a = left.withColumn("block_key", F.explode(F.array_distinct(left_keys)))
    b = right.withColumn("block_key", F.explode(F.array_distinct(right_keys)))
    return a.join(b, "block_key").dropDuplicates(list(ids)).drop("block_key")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt by those columns to as many tasks as shuffles have, however few its files are and however small it is."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


#: Pairs of rows that one part of a key gives, about; and the most parts of a key, by which its rows are copied.
PAIRS_OF_PART, PARTS_OF_KEY = 1 << 24, 256


def in_parts(left: DataFrame, right: DataFrame, key: str, pairs: int = PAIRS_OF_PART) -> DataFrame:
    """left ⋈ right on ``key`` where the pairs of a key may be far more than its rows.

    The rows of ``left`` of a key are dealt to some strips and those of ``right`` to others, and each strip meets each of the other side: as many parts
    as its pairs need (``pairs`` of each, PARTS_OF_KEY at most), in such a grid that the fewest rows are copied. n and m rows are 2 sqrt(PARTS_OF_KEY n m) at most and their own, so what is
    moved grows with the rows and not with the pairs, which take time alone. So no key is one task's work, and pairs are made behind the shuffles: what follows must not shuffle them again."""
    n = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_left")).join(right.groupBy(key).agg(F.count(F.lit(1)).alias("n_right")), key)
    parts = F.least(F.lit(PARTS_OF_KEY), F.ceil(F.col("n_left") * F.col("n_right") / pairs)).cast("double")
    n = n.withColumn("strips", F.least(F.col("n_left"), parts, F.ceil(F.sqrt(parts * F.col("n_left") / F.col("n_right")))).cast("int"))
    n = n.select(key, "strips", F.least(F.col("n_right"), F.ceil(parts / F.col("strips"))).cast("int").alias("others"))

    def dealt(df: DataFrame, own: str, copies: str) -> DataFrame:
        at = F.pmod(F.xxhash64(*df.columns), F.col(own)).cast("int")
        return df.join(n, key).select(*df.columns, at.alias(f"{own}_at"), F.explode(F.sequence(F.lit(0), F.col(copies) - 1)).alias(f"{copies}_at"))

    at = [key, "strips_at", "others_at"]
    # a given number of tasks, and no broadcast, as Spark would put small sides that make many pairs into one task
    return spread(dealt(left, "strips", "others"), *at).join(dealt(right, "others", "strips").hint("merge"), at).drop(*at[1:])


def guarded(edges: DataFrame, src: DataFrame, dst: DataFrame) -> DataFrame:
    """Edges (src, dst) whose ends are keys of both vertex tables."""
    return edges.join(src.select(F.col("key").alias("src")).distinct(), "src", "left_semi").join(dst.select(F.col("key").alias("dst")).distinct(), "dst", "left_semi")
