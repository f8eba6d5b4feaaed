"""Every query that SQL can express against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import DATA, same

from lodestone import plans

SQL = plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    got = plans.queries()[name](spark, DATA).toPandas()
    assert len(got) or name in ("overlay_estimates",)
    same(got, duck.execute(SQL[name]).df())
    spark.catalog.clearCache()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 9
    assert set(e.oracle_sql()) <= set(e.queries())


def test_listing_needs_no_session():
    import subprocess
    import sys

    from conftest import ROOT

    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 150"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=60)


LATE = ["cycle_stream", "merge_deltas_stream", "moving_stream", "trend_stream", "slice_trend_stream", "slot_stream"]


@pytest.mark.parametrize("name", LATE)
def test_events_of_any_date(spark, tmp_path, name):
    """The events of the tables, moved to the year 2031."""
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    con.execute(f"copy (select * replace (ts + interval 7 year as ts) from '{DATA}/events.parquet') to '{tmp_path}/events.parquet'")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    got = plans.queries()[name](spark, str(tmp_path)).toPandas()
    assert len(got)
    same(got, con.execute(SQL[name]).df())
