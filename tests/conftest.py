import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(base / "warehouse")).config("spark.checkpoint.dir", f"file://{base}/shared").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def against_sql(spark, sf_dir, query, sql):
    """The rows of a query and of its SQL, each sorted."""
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    return got, sorted(repr(tuple(plain(r[i]) for i in at)) for r in cur.fetchall())
