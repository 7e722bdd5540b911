"""Every registered query against its SQL, on whole tables."""

import datetime
import math

import duckdb
import pytest
from pyspark.sql import types as T

from __spark_entry__ import entry, oracle_sql, queries
from bercario.catalog.oracle import ORACLE
from bercario.catalog.queries import QUERIES

TABLES = ["region", "nation", "customer", "orders", "events"]


@pytest.fixture(scope="module")
def database():
    with duckdb.connect() as connection:
        yield connection


def expected(database, folder, sql):
    for table in TABLES:
        database.execute(f"CREATE OR REPLACE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    cursor = database.execute(sql)
    names = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    return names, types, cursor.fetchall()


def ordered(names, rows):
    positions = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in positions) for row in rows), key=repr)


DUCKDB_TYPES = {
    T.LongType: "BIGINT", T.StringType: "VARCHAR", T.DateType: "DATE",
    T.DoubleType: "DOUBLE", T.BooleanType: "BOOLEAN",
}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, database, name):
    frame = QUERIES[name](spark, folder)
    names, types, rows = expected(database, folder, ORACLE[name])
    assert sorted(frame.columns) == sorted(names)
    assert {f.name: DUCKDB_TYPES[type(f.dataType)] for f in frame.schema} == types
    found = [tuple(row) for row in frame.collect()]
    assert len(found) == len(rows) > 0
    assert ordered(frame.columns, found) == ordered(names, rows)


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 80
    assert all(isinstance(row["mes"], datetime.date) for row in rows)
    assert sum(row["situacao"] == "acima" for row in rows) == 32
    assert math.isclose(rows[0]["media"], 1041 / 80)
