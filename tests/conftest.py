import os
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parents[1]))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    session.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def rows(frame: pd.DataFrame) -> list:
    """Comparable whatever the engine's types for nulls and whole numbers are."""

    def plain(x):
        if x is None or x is pd.NA or isinstance(x, float) and x != x:
            return "null"
        if isinstance(x, float):
            return str(int(x)) if x == int(x) else repr(round(x, 6))
        return str(x)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False))


@pytest.fixture
def same(spark, duck):
    def check(query, sql):
        mine, theirs = query(spark, DATA).toPandas(), duck.execute(sql).df()
        assert sorted(mine.columns) == sorted(theirs.columns)
        assert rows(mine) == rows(theirs)

    return check
