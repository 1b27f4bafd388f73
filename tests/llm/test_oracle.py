"""The queries that SQL can express, against that SQL."""

import glob
import os

import duckdb
import pytest

from vocalis.llm.catalog import QUERIES
from vocalis.llm.oracle import ORACLE


def _ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        duck.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _ordered(df.collect(), df.columns) == _ordered(result.fetchall(), columns)
