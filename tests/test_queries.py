"""Every registered query against its SQL on the driver tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from dossier.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def rows(names, columns, data):
    order = [columns.index(name) for name in names]
    return sorted(repr(tuple(row[i] for i in order)) for row in data)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    names = sorted(df.columns)
    assert names == sorted(columns)
    found = rows(names, df.columns, [tuple(r) for r in df.collect()])
    assert found and found == rows(names, columns, result.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["customerId", "forename", "surname", "numberAccounts", "numberAddresses", "linked"]
    assert df.count() == 1500
