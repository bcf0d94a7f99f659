"""Every query against its SQL, as the driver compares them."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract

DIRECTORY = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DIRECTORY}/{table}.parquet'")
    return connection


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def types_by_name(columns, types):
    names = {"VARCHAR": "string", "DOUBLE": "double", "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean"}
    return sorted((c, names.get(str(t), str(t))) for c, t in zip(columns, types))


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    found = contract.queries()[name](spark, DIRECTORY)
    rows = [tuple(r) for r in found.collect()]
    assert rows
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    expected = duck.sql(sql)
    found_types = [f.dataType.simpleString() for f in found.schema]
    assert types_by_name(found.columns, found_types) == types_by_name(expected.columns, expected.types)
    assert rows_by_name(found.columns, rows) == rows_by_name(expected.columns, expected.fetchall())


def test_oracle_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 200
