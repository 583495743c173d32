"""Every query of the ingestion part against its SQL, on the smallest tables."""

import os

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as driver

QUERIES = {name[2:]: query for name, query in vars(driver).items() if name.startswith("q_")}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.execute(f"create view {file.removesuffix('.parquet')} as select * from '{DATA}/{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(driver._oracle_sql())
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == ["name", "count_of_names"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    made = QUERIES[name](spark, DATA)
    wanted = database.execute(driver.oracle_sql()[name])
    names = [c[0] for c in wanted.description]
    assert sorted(made.columns) == sorted(names)
    rows = [repr(tuple(r[c] for c in names)) for r in made.collect()]
    assert sorted(rows) == sorted(map(repr, wanted.fetchall()))
    assert rows
