"""Every named query against its DuckDB oracle at the smallest scale."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from orderloom.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert registry.queries().keys() == registry.oracle_sql().keys()
    assert registry.queries().keys() <= driver.queries().keys()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, db, name):
    df = driver.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = db.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    assert got == want
