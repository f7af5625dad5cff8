"""Every registered query against DuckDB on the same files."""

from __future__ import annotations

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from merchlake.plans.catalog import QUERIES
from merchlake.plans.oracle import ORACLE

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(str(v) for v in r))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    answer = QUERIES[name](spark, TESTDATA)
    columns = sorted(answer.columns)
    kinds = {c: t for c, t, *_ in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {c: KINDS[t] for c, t in answer.dtypes} == kinds
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"SELECT {picked} FROM ({ORACLE[name]})").fetchall()
    assert ordered(answer.select(*[f"`{c}`" for c in columns]).collect()) == ordered(expected)
