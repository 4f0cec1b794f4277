"""Paged records, running sums and budgets, with a key that holds most rows."""

import datetime
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from orgloom.operators.running import running
from orgloom.plans import links
from orgloom.sources import paged, scratch


@pytest.fixture
def many_tasks(spark):
    """So few rows are one task's otherwise."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def hot_rows(n, seed=1):
    r = random.Random(seed)
    return [(r.choice(["hot"] * 8 + ["a", "b", None]), r.randrange(n), r.randrange(-5, 90) if seed == 2 else r.randrange(90), i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_running_sums(many_tasks, seed):
    rows = hot_rows(3000, seed) + [("gone", 5, None, -1)]
    df = many_tasks.createDataFrame(rows, "k string, at long, n long, id long")
    out = running(df, ["k"], [F.desc("at"), F.asc("id")], {"total": F.col("n"), "nth": F.lit(1)})
    assert out.columns == ["k", "at", "n", "id", "total", "nth"]
    got = {r["id"]: (r["total"], r["nth"]) for r in out.collect()}
    sums = {}
    for k, _, n, i in sorted(rows, key=lambda r: (-r[1], r[3])):
        s = sums.setdefault(k, [0, 0])
        s[0] += n or 0
        s[1] += 1
        assert got[i] == tuple(s)
    assert len(got) == len(rows)


def test_running_sums_of_one_key_use_many_tasks(many_tasks):
    df = many_tasks.range(2000).select(F.lit("one").alias("k"), F.col("id").alias("at"))
    spread = running(df, ["k"], [F.asc("at")], {"nth": F.lit(1)}).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 1500
    same = running(many_tasks.range(2000).select(F.lit(None).cast("string").alias("k"), F.lit(1).alias("at")), ["k"], [F.asc("at")], {"nth": F.lit(1)})
    assert sorted(r["nth"] for r in same.collect()) == list(range(1, 2001))  # copies of one place, too
    assert running(df.limit(0), ["k"], [F.asc("at")], {"nth": F.lit(1)}).collect() == []


def test_budget_of_a_hot_committer(many_tasks):
    rows = [(k, at, n) for k, at, n, _ in {(r[0], r[1]): r for r in hot_rows(3000)}.values()]
    df = many_tasks.createDataFrame([*rows, ("hot", None, 3)], "COMMITTER_ID string, ORD long, N long")
    for crossing in (True, False):
        got = sorted(map(repr, ((r["COMMITTER_ID"], r["ORD"]) for r in links.budget(df, 2000, crossing).collect())))
        want = []
        for k in {r[0] for r in rows}:
            total = 0
            for nth, (_, at, n) in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: -r[1])):
                if (total > 2000) if crossing else (nth and total + n + nth > 2000):
                    break
                total += n
                want.append(repr((k, at)))
        assert got == sorted(want)


def landed(spark, n=500, page=20):
    at = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT), 0.000123)")
    rows = spark.range(n).select(F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "a b").otherwise(None).alias("REPO"), F.col("id").alias("N"), at.alias("UPDATED_AT"), F.struct(F.col("id").alias("x")).alias("S"))
    return rows, *paged.land_pages(rows, "REPO", [F.desc("UPDATED_AT")], page)


def test_pages_hold_all_records(spark):
    rows, path, schema = landed(spark)
    back = paged.paged(spark, path, schema, "REPO", "UPDATED_AT", pages_of_a_task=3)
    want = rows.filter("REPO IS NOT NULL")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    assert back.rdd.getNumPartitions() == 7 + 1  # 20 pages of the one, 3 of the other
    for f in glob.glob(path.removeprefix("file://") + "/REPO=hot/page=*"):
        assert len(glob.glob(f + "/*.json")) == 1


def spoil(path, source, first):
    """Pages from ``first`` on can't be read any more."""
    n = 0
    for f in glob.glob(f"{path.removeprefix('file://')}/REPO={source}/page=*/*.json"):
        if int(f.split("page=")[1].split("/")[0]) >= first:
            os.chmod(f, 0o644)
            with open(f, "w") as out:
                out.write('{"N": broken')
            n += 1
    return n


def test_old_pages_are_not_opened(spark):
    rows, path, schema = landed(spark)
    cutoff = datetime.datetime(2024, 1, 1, 7, 0, 0)  # the last 80 of 500 records
    assert spoil(path, "hot", 5) == 15 and spoil(path, "a b", 2) == 1
    back = paged.paged(spark, path, schema, "REPO", "UPDATED_AT")
    got = back.filter(F.col("UPDATED_AT") >= F.lit(cutoff)).select("N")
    want = rows.filter("REPO IS NOT NULL").filter(F.col("UPDATED_AT") >= F.lit(cutoff)).select("N")
    assert got.count() == want.count() > 60 and got.exceptAll(want).count() == 0
    with pytest.raises(Exception, match="JSON"):
        back.select("N").collect()


def test_sources_choose_folders(spark):
    _, path, schema = landed(spark)
    spoil(path, "hot", 0)
    back = paged.paged(spark, path, schema, "REPO", "UPDATED_AT").filter("REPO = 'a b'")
    assert back.count() == 50
    assert paged.paged(spark, path, schema, "REPO").filter("REPO IN ('a b', 'none')").count() == 50
    assert paged.paged(spark, path + "-none", schema, "REPO").count() == 0


def test_a_table_forgets_what_was_pushed(spark):
    _, path, schema = landed(spark)
    t = paged.paged(spark, path, schema, "REPO", "UPDATED_AT")
    new = t.filter(F.col("UPDATED_AT") >= F.lit(datetime.datetime(2024, 1, 1, 7, 0, 0)))
    assert [new.count(), t.count(), t.filter("REPO = 'a b'").count(), t.count(), new.count(), t.select("N").count()] == [72, 450, 50, 450, 72, 450]


def test_scratch_folders_go(spark):
    path = scratch.scratch_dir(spark, "t")
    spark.range(3).write.parquet(path)
    assert scratch.release(spark) >= 1
    assert not os.path.exists(path.removeprefix("file://"))
