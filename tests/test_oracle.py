"""Every registered query against its SQL, on the driver's tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("SYMGRID_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents benchmark".split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)
    return sorted((tuple(row) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(set(driver.queries()) & set(driver.oracle_sql())))
def test_query_matches_oracle(spark, oracle, name):
    got = driver.queries()[name](spark, SF_DIR).toPandas()
    want = oracle.execute(driver.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert normal(got) == normal(want)


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["total"]
    assert result.first().total > 0
