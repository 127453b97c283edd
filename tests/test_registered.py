"""What the registered queries write beside what they are about, on hand-made given tables."""

from __future__ import annotations

import datetime as dt

import pytest

from catalog.registry import Warehouse, builders
from siltstone.plans import facts

DAY = dt.datetime(1996, 3, 1)
GIVEN = {
    "region": ("r_regionkey int, r_name string", [(0, "AFRICA"), (1, "ASIA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "KENYA", 0), (1, "JAPAN", 1)]),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(k, f"Customer#{k:09}", k % 2, 100.0 * k, "BUILDING") for k in range(1, 9)],
    ),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(k, f"S{k}", 0, 1.0) for k in (1, 2)]),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(k, f"part {k}", "Brand#11", "PROMO", 10 + 10 * k, 1.0) for k in range(1, 6)],
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
        " o_orderpriority string",
        [(k, k, "F", 10.0 * k, DAY, "1-URGENT") for k in range(1, 9)],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        [(k, k % 5 + 1, 1, 1, 3.0, 5.0, 0.0, 0.01, "R", "F", DAY) for k in range(1, 9)],
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
        [(k, dt.datetime(2024, 1, k), k, ("view", "error", "purchase")[k % 3], 3.0) for k in range(1, 9)],
    ),
}


@pytest.fixture
def lake(spark, rows_of, tmp_path):
    for name, (schema, rows) in GIVEN.items():
        rows_of(schema, *rows).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return Warehouse(spark, str(tmp_path))


def test_the_first_state_of_a_source_is_computed_once(lake, monkeypatch):
    """Bronze of both loads and the watermark between them come from one extract."""
    asked, source = [], lake.source
    monkeypatch.setattr(lake, "source", lambda name, load=2: (asked.append(load), source(name, load))[1])
    full, both = lake.stored_bronze("rental", 1), lake.stored_bronze("rental")
    assert asked == [1, 2] and full.count() == 8
    assert both.exceptAll(lake.bronze("rental", 2)).count() == lake.bronze("rental", 2).exceptAll(both).count() == 0


def test_a_refresh_writes_the_dense_rows_for_the_sink_only(lake):
    found = builders()["fact_refresh"](lake)
    assert found.count() > 0 and {r.rows_after_empty_refresh for r in found.select("rows_after_empty_refresh").distinct().collect()} == {0}
    assert not lake._kept.keys() & facts.FACTS.keys()


def test_a_rerun_makes_each_fact_in_the_store_and_keeps_no_copy(lake):
    found = {r.table_name: r for r in builders()["check_rerun_digests"](lake).collect()}
    assert len(found) == 22 and all(r.is_equal for r in found.values())
    assert found["customer"].row_count > 0 and any(found[f].row_count for f in facts.FACTS)
    assert not lake._kept.keys() & {*facts.FACTS, "silver2_rental"} and "rental" not in lake.silver()._kept


def test_reject_counts_keep_no_copy_of_the_stored_tables(lake):
    found = builders()["reject_counts"](lake).collect()
    assert found and all(r.counted == r.stored for r in found)
    assert not lake._kept and not lake.silver()._kept
