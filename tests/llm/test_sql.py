"""The queries that SQL can express, against the oracle engine."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from cases import FOLDER

from siltstone.llm.catalog import oracle_queries, queries

SQL = oracle_queries()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_names():
    assert set(SQL) < set(queries())
    assert {n.split("_")[0] for n in queries()} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, oracle, name):
    rows = queries()[name](spark, FOLDER)
    columns = sorted(rows.columns)
    found = oracle.execute(SQL[name])
    order = [c[0] for c in found.description]
    assert sorted(order) == columns
    expected = sorted((tuple(r[order.index(c)] for c in columns) for r in found.fetchall()), key=str)
    assert sorted(map(tuple, rows.select(*columns).collect()), key=str) == expected
