"""Every registered query beside its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_file
from shopledger.sources import shop_tables
from check import TABLES, duck_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry_file.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    names, got, _ = spark_rows(entry_file.queries()[name](spark, FOLDER))
    expected_names, expected, _ = duck_rows(duck, entry_file.oracle_sql()[name])
    assert names == expected_names
    assert got == expected
    assert got, "a query without rows proves nothing"


def test_random_sample(spark):
    got = entry_file.queries()["l4_random_sample"](spark, FOLDER).collect()
    carted = {(r.user_id, str(r.product_id)) for r in shop_tables.user_carts(spark, FOLDER).collect()}
    assert got
    for r in got:
        ids = r["sample"].split(" ")
        assert 0 < len(ids) <= 5 and len(set(ids)) == len(ids)
        assert not any((r.user_id, i) in carted for i in ids)


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
