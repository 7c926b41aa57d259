import os

import pandas as pd
import pytest
from pyspark.sql import SparkSession

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        path = f"{sf}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return c


def canonical(frame):
    """Rows of a pandas frame as sorted text, columns by name."""
    columns = sorted(frame.columns)

    def cell(v):
        if pd.isna(v):
            return "null"
        if hasattr(v, "item"):
            v = v.item()
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return columns, sorted(tuple(cell(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False))
