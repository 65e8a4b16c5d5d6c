"""Every query that SQL can express gives what DuckDB gives on the same tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from harborline.plans import registry

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
        return "null"
    if isinstance(x, bool) or type(x).__name__ == "bool":
        return str(bool(x))
    if isinstance(x, pd.Timestamp) or hasattr(x, "isoformat"):
        t = pd.Timestamp(x)
        return (t.tz_localize(None) if t.tzinfo else t).isoformat()
    try:
        return f"{float(x):.9g}"
    except (TypeError, ValueError):
        return str(x)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, duck, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert not __spark_entry__.entry(spark).isEmpty()
