"""Every registered query against its SQL in the oracle engine."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from catalog.oracle import oracle_queries
from catalog.registry import builders, registered, warehouse

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registered(), oracle_queries()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rounded(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    rows = QUERIES[name](spark, FOLDER)
    columns = sorted(rows.columns)
    found = oracle.execute(SQL[name])
    order = [c[0] for c in found.description]
    assert sorted(order) == columns
    expected = sorted((rounded(r[order.index(c)] for c in columns) for r in found.fetchall()), key=str)
    assert sorted((rounded(r) for r in rows.select(*columns).collect()), key=str) == expected


def test_no_plan_pairs_rows_without_a_key(spark):
    """With broadcasts off, as for large tables, all joins are equi joins."""
    names = (
        "silver_rental",
        "silver_payment",
        "silver_inventory_item",
        "profile_customer",
        "dim_customer_second_load",
        "scd2_changes",
        "scd2_as_of_join",
        "inventory_status_day",
        "agg_revenue_month",
        "fact_customer_daily_activity",
        "fact_content_monthly_performance",
        "fact_inventory_daily_utilization",
        "audit_finish",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in names:
            rows = builders()[name](warehouse(spark, FOLDER))
            plan = rows._jdf.queryExecution().executedPlan().toString()
            for unwanted in ("NestedLoop", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
                assert unwanted not in plan, (name, unwanted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("fact", ["fact_customer_daily_activity", "fact_inventory_daily_utilization"])
def test_dense_rows_are_never_shuffled(spark, fact):
    rows = builders()[fact](warehouse(spark, FOLDER))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate explode")]
