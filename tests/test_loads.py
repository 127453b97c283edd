"""Two days of the whole warehouse through a store, on the given tables."""

from __future__ import annotations

import datetime as dt

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from catalog.registry import LOADS, NOW, warehouse
from catalog.shapes import SOURCE_TABLES
from siltstone.operators.audit import COUNTS
from siltstone.operators.checks import state_difference
from siltstone.plans import loads
from siltstone.plans.facts import FACTS
from siltstone.sources import TableStore

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    return warehouse(spark, FOLDER)


@pytest.fixture(scope="module")
def loaded(spark, lake, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("warehouse")))
    first = {t: lake.source(t, 1) for t in SOURCE_TABLES}
    second = {t: lake.source(t, 2) for t in SOURCE_TABLES}
    results = {}

    def run(name, tasks, load):
        start = dt.datetime(2024, 3, 31, 1)
        run = ("20240331", name, "run")
        results[name] = loads.audited(store, run, start, lambda: start, tuple(tasks), load)

    run("full", SOURCE_TABLES, lambda: loads.load_bronze_full(store, first, LOADS[1], "crm"))
    run("silver 1", SOURCE_TABLES, lambda: loads.load_silver(store, LOADS[1]))
    run("dims 1", (), lambda: loads.load_dimensions(store))
    run("delta", SOURCE_TABLES, lambda: loads.load_bronze_delta(store, second, NOW.ts, NOW, "crm", "day 2"))
    run("silver 2", SOURCE_TABLES, lambda: loads.load_silver(store, NOW))
    run("dims 2", (), lambda: loads.load_dimensions(store))
    run("facts", FACTS, lambda: loads.load_facts(store, NOW))
    return store, results


def test_loads_give_what_the_queries_give(loaded, lake):
    store, _ = loaded
    pairs = {f"silver.{t}": lake.silver()[t] for t in ("customer", "inventory_item", "payment")}
    pairs |= {f"gold.{d}": lake.dimension(d) for d in ("dim_customer", "dim_content")}
    pairs |= {f"gold.{f}": lake.fact(f) for f in FACTS}
    for table, expected in pairs.items():
        found = store.read(table)
        # Here the sources carry another label.
        if "source_system" in found.columns:
            expected, found = expected.drop("source_system"), found.drop("source_system")
        assert state_difference(expected, found).count() == 0, table


def test_audit_has_a_closed_record_per_load(loaded):
    store, results = loaded
    records = {r.dag_id: r for r in store.read(loads.AUDIT_TABLE).collect()}
    assert set(records) == set(results)
    assert {r.status for r in records.values()} == {"Success"}
    delta = records["delta"]
    assert delta.source_record_count == sum(results["delta"].values()) > 0
    silver = records["silver 2"]
    for i, c in enumerate(COUNTS):
        assert silver[i + 7] == sum(r[c] for r in results["silver 2"].values())
    assert silver.rejected_record_count > 0
    assert records["facts"].processed_record_count == sum(store.row_count(f"gold.{f}") for f in FACTS)


def test_repeating_facts_and_delta_changes_nothing(loaded, lake):
    store, _ = loaded
    before = {f: store.read(f"gold.{f}") for f in FACTS}
    loads.load_facts(store, NOW)
    for f, rows in before.items():
        assert state_difference(rows, store.read(f"gold.{f}")).count() == 0
    source = {"rental": lake.source("rental", 2)}
    assert loads.load_bronze_delta(store, source, NOW.ts, NOW, "crm") == {"rental": 0}


def test_a_load_that_raises_leaves_a_failed_record(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))

    def broken():
        raise RuntimeError("no source")

    start = dt.datetime(2024, 3, 31)
    with pytest.raises(RuntimeError, match="no source"):
        loads.audited(store, ("b", "d", "r"), start, lambda: start, ("a", "b"), broken)
    record = store.read(loads.AUDIT_TABLE).first()
    assert (record.status, record.source_record_count) == ("Failed", 0)


SOURCE = "id bigint, created_at timestamp_ntz, updated_at timestamp_ntz"


def day(n):
    return dt.datetime(2024, 1, n)


def test_a_repeated_batch_loses_no_row(spark, rows_of, tmp_path):
    """The source grows between the first run of a batch and its repeat."""
    store = TableStore(spark, str(tmp_path))

    def load(batch, until, *rows):
        source = {"t": rows_of(SOURCE, *rows)}
        loads.load_bronze_delta(store, source, until, NOW, "crm", batch)
        return sorted(r.id for r in store.read("bronze.t").collect())

    one, two, three = (1, day(1), None), (2, day(2), None), (3, day(2), None)
    # A delta load without a table takes everything.
    assert load("d1", day(1), one) == [1]
    assert load("d2", day(2), one, two) == [1, 2]
    assert load("d2", day(2), one, two, three) == [1, 2, 3]
    assert load("d3", day(3), one, two, three, (4, day(3), None)) == [1, 2, 3, 4]


def test_a_failed_table_does_not_hide_the_others(spark, rows_of, tmp_path):
    store = TableStore(spark, str(tmp_path))
    bad = rows_of(SOURCE, (1, day(1), None)).withColumn("id", F.raise_error(F.lit("broken")).cast("bigint"))
    sources = {"a": rows_of(SOURCE, (1, day(1), None)), "b": bad, "c": rows_of(SOURCE, (1, day(1), None), (2, day(1), None))}
    run, start = ("b", "d", "r"), dt.datetime(2024, 3, 31)
    for _ in range(2):
        with pytest.raises(loads.PartlyFailed, match="broken"):
            loads.audited(
                store, run, start, lambda: start, tuple(sources),
                lambda: loads.load_bronze_full(store, sources, NOW, "crm"),
            )
        # Also after a repeat there is one record of the run.
        [record] = store.read(loads.AUDIT_TABLE).collect()
        assert (record.status, record.processed_record_count) == ("Failed", 3)


def test_pipelines_that_close_at_once_keep_their_records(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    start = dt.datetime(2024, 3, 31)

    def run(n):
        loads.audited(store, ("b", f"d{n}", "r"), start, lambda: start, ("t",), lambda: {"t": n})

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(run, range(4)))
    found = {r.dag_id: (r.status, r.processed_record_count) for r in store.read(loads.AUDIT_TABLE).collect()}
    assert found == {f"d{n}": ("Success", n) for n in range(4)}


def test_children_of_a_failed_parent_are_skipped(loaded, lake, monkeypatch):
    store, _ = loaded
    broken = loads.cleanse

    def cleanse(bronze, spec, silver, as_of):
        if spec is loads.SPECS["content"]:
            raise RuntimeError("no content")
        return broken(bronze, spec, silver, as_of)

    monkeypatch.setattr(loads, "cleanse", cleanse)
    with pytest.raises(loads.PartlyFailed) as failure:
        loads.load_silver(store, NOW)
    errors = failure.value.errors
    assert "no content" in str(errors["content"]) and "skipped" in str(errors["inventory_item"])
    assert "customer" in failure.value.results and not errors.keys() & failure.value.results.keys()


def test_dimension_loads_report_what_they_did(loaded):
    _, results = loaded
    first, second = results["dims 1"], results["dims 2"]
    assert all(r["closed_versions"] == 0 and r["new_versions"] > 0 for r in first.values())
    assert second["dim_customer"]["closed_versions"] > 0
    assert all(r["inserted_record_count"] == 0 for r in second.values())


def test_ended_versions_stay_in_their_files(loaded):
    store, _ = loaded

    def ended():
        return {p["dir"] for p in store._manifest("gold.dim_customer")["parts"] if p["batch"] == loads.ENDED}

    before, rows = ended(), store.row_count("gold.dim_customer")
    assert before
    loads.load_dimensions(store)
    assert ended() == before and store.row_count("gold.dim_customer") == rows


def test_a_table_of_untagged_parts_keeps_its_history(spark, loaded, lake, tmp_path):
    """A dimension that a full refresh wrote, ended versions included, is loaded like one of tagged parts."""
    store, _ = loaded
    other = TableStore(spark, str(tmp_path))
    for source in {s for _, s in loads.DIMENSIONS.values()}:
        other.replace(f"silver.{source}", store.read(f"silver.{source}"))
    for name in loads.DIMENSIONS:
        other.replace(f"gold.{name}", store.read(f"gold.{name}"))
    assert other.read("gold.dim_customer").where("NOT is_current").count() > 0
    for _ in range(2):
        results = loads.load_dimensions(other)
        for name in loads.DIMENSIONS:
            table = f"gold.{name}"
            assert state_difference(store.read(table), other.read(table)).count() == 0, name
            assert {p["batch"] for p in other._manifest(table)["parts"]} <= {loads.CURRENT, loads.ENDED}
            assert (results[name]["new_versions"], results[name]["closed_versions"]) == (0, 0)
