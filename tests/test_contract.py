import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for file in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, float):
        return f"f{value!r}"
    return f"s{value}"


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_keys(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) >= 80


@pytest.mark.parametrize("key", sorted(contract.queries()))
def test_query_equals_its_sql(spark, duck, sf, key):
    df = contract.queries()[key](spark, sf)
    columns = sorted(df.columns)
    rows = sorted(",".join(plain(v) for v in r) for r in df.select(columns).collect())
    sql = contract.oracle_sql().get(key)
    if sql is None:
        assert rows
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(",".join(plain(r[i]) for i in order) for r in cursor.fetchall())
