"""Every registered query against its SQL on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from devtide.plans import registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return con


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, database, name):
    df = driver.queries()[name](spark, SF_DIR)
    cursor = database.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = sorted((tuple(r) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert got == expected
