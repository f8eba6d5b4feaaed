from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def same(a, b):
    """Do two pandas frames hold the same rows, whatever the order?"""
    import pandas as pd

    def norm(df):
        df = df[sorted(df.columns)].copy()
        for c in df.columns:
            if df[c].dtype.kind in "iuf":
                df[c] = df[c].map(lambda v: "NULL" if pd.isna(v) else repr(float(v) + 0.0))
            else:
                df[c] = df[c].map(lambda v: "NULL" if v is None or (not hasattr(v, "__len__") and pd.isna(v)) else str(v))
        return df.sort_values(list(df.columns)).reset_index(drop=True)

    assert sorted(a.columns) == sorted(b.columns)
    a, b = norm(a), norm(b)
    assert len(a) == len(b)
    pd.testing.assert_frame_equal(a, b)
