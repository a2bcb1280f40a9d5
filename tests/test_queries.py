"""Every registered query of the base against DuckDB at the smallest scale."""

import os

import duckdb
import pandas as pd
import pytest

from folioql.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and v != v:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return int(v) if v == int(v) and abs(v) < 2**53 else round(v, 9)
    return tuple(map(plain, v)) if isinstance(v, list) else v


def table(df, columns):
    return sorted((tuple(map(plain, r)) for r in df[columns].astype(object).values.tolist()), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(want) > 0
    assert table(got, columns) == table(want, columns)


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
