import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "4g", "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="fraudflow-test-"), "spark.default.parallelism": "4",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.fixture(scope="session")
def agree(spark, duck):
    """Compares a query with its SQL, row for row."""

    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    def check(query, sql):
        df = query(spark, SF)
        columns = sorted(df.columns)
        got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        want = sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in found.fetchall())
        assert got == want

    return check
