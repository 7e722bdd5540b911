"""The training-data queries that SQL can express, on whole tables."""

import duckdb
import pytest

from bercario.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, name):
    rows = QUERIES[name](spark, folder)
    with duckdb.connect() as database:
        for table in ("documents", "benchmark", "labels", "pages", "embeddings"):
            database.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
        expected = database.execute(ORACLE[name])
        names = [column[0] for column in expected.description]
        assert sorted(names) == sorted(rows.columns)
        found = sorted(map(repr, (tuple(r) for r in rows.select(*names).collect())))
        assert found == sorted(map(repr, expected.fetchall()))
