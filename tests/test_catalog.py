"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from vocalis.catalog.oracle import ORACLE
from vocalis.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rounded = [[round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order] for r in rows]
    return sorted(map(repr, rounded))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered(df.collect(), df.columns) == ordered(result.fetchall(), columns)


def test_every_query_has_sql_and_entry_runs(spark):
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())
    assert driver.entry(spark).count() > 0
