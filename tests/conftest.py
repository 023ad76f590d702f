import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def same(spark, duck):
    """Compares a query with its SQL, rows in any order."""

    def value(v):
        return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v) if type(v).__name__ == "datetime" else v

    def check(query, sql):
        df = query(spark, DATA)
        cols = sorted(df.columns)
        got = sorted((tuple(map(value, r)) for r in df.select(*cols).collect()), key=repr)
        cur = duck.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        want = sorted((tuple(value(r[i]) for i in at) for r in cur.fetchall()), key=repr)
        assert got == want

    return check
