"""Every registered query against its checking SQL, on the smallest given tables."""

import datetime
import decimal
import glob
import math
import os

import pytest

import __spark_entry__ as registered

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value.isoformat() if isinstance(value, datetime.datetime) else value


def in_order(names, rows):
    places = sorted(range(len(names)), key=names.__getitem__)
    return sorted([tuple(plain(row[i]) for i in places) for row in rows], key=repr)


def test_queries_without_checking_sql_have_tests_of_their_own():
    missing = set(registered.queries()) - set(registered.oracle_sql())
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert all(name.startswith("op") or name == "pipeline" for name in missing)


@pytest.mark.parametrize("name", registered.oracle_sql())
def test_query(spark, database, name):
    found = registered.queries()[name](spark, FOLDER)
    expected = database.execute(registered.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(found.columns) == sorted(names)
    assert in_order(found.columns, found.collect()) == in_order(names, expected.fetchall())


def test_entry(spark):
    found = {row["column_name"]: row for row in registered.entry(spark).collect()}
    assert found["o_orderkey"]["distinct_count"] == found["o_orderkey"]["row_count"]
