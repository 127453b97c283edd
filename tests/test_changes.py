"""Silver from changes equals Silver from all of Bronze, load after load."""

from __future__ import annotations

import datetime as dt
import random
import shutil

import pytest

from siltstone.functions.dates import AsOf
from siltstone.functions.text import blank_to_null
from siltstone.operators.checks import state_difference
from siltstone.operators.cleanse import Reference, TableSpec
from siltstone.operators.rejects import reject_reasons
from siltstone.operators.rules import moment_passed, not_negative
from siltstone.plans import loads
from siltstone.sources import TableStore

COLUMNS = "{} created_at timestamp_ntz, updated_at timestamp_ntz, load_timestamp timestamp_ntz, source_system string"
SPECS = {
    "mother": TableSpec("mother", ("m_id",), ("m_id", "n"), required=("n",), rules=(not_negative("n"),)),
    "child": TableSpec(
        "child", ("c_id",), ("c_id", "m_id", "code", "at"), clean={"code": blank_to_null}, required=("m_id",),
        rules=(moment_passed("at"),), references=(Reference("m_id", "mother"),), unique="code",
    ),
    "toy": TableSpec("toy", ("t_id",), ("t_id", "c_id"), references=(Reference("c_id", "child", optional=True),)),
}
SCHEMAS = {
    "mother": COLUMNS.format("m_id bigint, n int,"),
    "child": COLUMNS.format("c_id bigint, m_id bigint, code string, at timestamp_ntz,"),
    "toy": COLUMNS.format("t_id bigint, c_id bigint,"),
}


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def stores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "SPECS", SPECS)
    monkeypatch.setattr(loads, "PROFILES", {})
    return TableStore(spark, str(tmp_path / "a")), TableStore(spark, str(tmp_path / "b"))


@pytest.fixture
def rows_of(rows_of):
    return lambda *given: rows_of(*given).coalesce(1)


def delta(rng, load, size):
    """Changed rows: good ones, bad ones, repeated keys, ties, ones that lie in the future for some loads."""

    def times():
        return (rng.choice([None, day(load)]), rng.choice([None, day(load), day(load + 1)]), day(load), "crm")

    def some(n):
        return rng.choice([None, *range(n)])

    return {
        "mother": [(some(6), rng.choice([None, -1, 1, 2]), *times()) for _ in range(size)],
        "child": [
            (some(12), some(7), rng.choice([" a", "b ", "c", "d", "e", " ", None]), day(rng.randrange(8)), *times())
            for _ in range(2 * size)
        ],
        "toy": [(some(20), some(13), *times()) for _ in range(2 * size)],
    }


def check(stores, load):
    changed, rebuilt = stores
    as_of = AsOf(day(load))
    found, expected = loads.load_silver_changes(changed, as_of), loads.load_silver(rebuilt, as_of)
    assert found == expected
    for name in SPECS:
        table = f"silver.{name}"
        assert state_difference(rebuilt.read(table), changed.read(table)).count() == 0, (name, load)


def test_equal_to_the_rebuild(stores, rows_of):
    rng = random.Random(1)
    for load in range(3):
        for name, rows in delta(rng, load, (10, 4, 0)[load]).items():
            for store in stores:
                store.append(f"bronze.{name}", rows_of(SCHEMAS[name], *rows), batch=f"{load}")
        check(stores, load)
    # An earlier moment, a batch that is repeated with other rows, a full refresh.
    check(stores, 1)
    for name, rows in delta(rng, 5, 3).items():
        for store in stores:
            store.append(f"bronze.{name}", rows_of(SCHEMAS[name], *rows), batch="1")
    check(stores, 5)
    for store in stores:
        store.replace("bronze.mother", rows_of(SCHEMAS["mother"], (1, -1, None, None, day(6), "crm")))
    check(stores, 6)
    # Nothing is left of the parent, so its rows stay; they go with the first good row.
    for store in stores:
        store.append("bronze.mother", rows_of(SCHEMAS["mother"], (5, 1, None, None, day(7), "crm")))
    check(stores, 7)


def test_bronze_history_is_not_read(stores, rows_of):
    """With the files of an earlier delta gone, a load still works; a bad newest version takes its children along."""
    first = {
        "mother": [(1, 1, None, day(0), day(0), "crm"), (2, 1, None, day(0), day(0), "crm")],
        "child": [(1, 1, "a", day(0), None, day(0), day(0), "crm"), (2, 2, "b", day(0), None, day(0), day(0), "crm")],
        "toy": [(1, 1, None, day(0), day(0), "crm"), (2, 2, None, day(0), day(0), "crm"), (3, None, None, None, day(0), "crm")],
    }
    for name, rows in first.items():
        for store in stores:
            store.append(f"bronze.{name}", rows_of(SCHEMAS[name], *rows))
    check(stores, 0)
    changed, rebuilt = stores
    for name in SPECS:
        for part in changed.snapshot(f"bronze.{name}").parts:
            shutil.rmtree(f"{changed.root}/bronze.{name}/{part['dir']}")
    bad = (2, -1, None, day(1), day(1), "crm")
    for store in stores:
        store.append("bronze.mother", rows_of(SCHEMAS["mother"], bad))
    check(stores, 1)
    assert [r.t_id for r in changed.read("silver.toy").orderBy("t_id").collect()] == [1, 3]


def test_a_parent_loaded_alone_is_noticed(stores, rows_of, monkeypatch):
    """A load that stops behind the parent: the next one judges all its children."""
    for store in stores:
        store.append("bronze.mother", rows_of(SCHEMAS["mother"], (1, 1, None, day(0), day(0), "crm")))
        store.append("bronze.child", rows_of(SCHEMAS["child"], (1, 1, "a", day(0), None, day(0), day(0), "crm")))
        store.append("bronze.toy", rows_of(SCHEMAS["toy"], (1, 1, None, day(0), day(0), "crm")))
    check(stores, 0)
    for store in stores:
        store.append("bronze.mother", rows_of(SCHEMAS["mother"], (1, -1, None, day(1), day(1), "crm"), (2, 1, None, None, day(1), "crm")))
        store.append("bronze.child", rows_of(SCHEMAS["child"], (3, 2, "c", day(0), None, day(1), day(1), "crm")))
    run = loads.TableChange.run

    def stops(self, *args):
        if self.spec.name == "child":
            raise RuntimeError("stopped")
        return run(self, *args)

    with monkeypatch.context() as broken:
        broken.setattr(loads.TableChange, "run", stops)
        with pytest.raises(loads.PartlyFailed):
            loads.load_silver_changes(stores[0], AsOf(day(1)))
    check(stores, 1)
    assert [r.c_id for r in stores[0].read("silver.child").collect()] == [3]


def test_reasons_add_up(stores, rows_of):
    """Every dropped row has one reason, in the order of the checks; hot keys and NULLs included."""
    store, rng = stores[0], random.Random(7)
    given = delta(rng, 3, 40)
    given["child"] += [(5, 1, "zz", day(0), None, day(2), day(3), "crm")] * 50
    for name, rows in given.items():
        store.append(f"bronze.{name}", rows_of(SCHEMAS[name], *rows))
    loads.load_silver(store, AsOf(day(4)))
    found = loads.load_rejects(store, AsOf(day(4)))
    for name in SPECS:
        assert sum(found[name].values()) == store.row_count(f"bronze.{name}") - store.row_count(f"silver.{name}")
        assert sum(found[name].values()) == store.row_count(f"rejects.{name}")
    assert {"key missing", "superseded", "n missing", "n negative"} <= set(found["mother"])
    assert {"code shared", "code missing"} <= set(found["child"])
    rows = rows_of(SCHEMAS["child"], (1, None, "a", day(9), None, None, None, None), (2, 1, " a ", day(9), None, None, None, None),
                   (3, None, "b", day(9), None, None, None, None), (4, 8, "c", day(9), None, None, None, None))
    parents = {"mother": rows_of("m_id bigint", (1,))}
    reasons = {r.row_key: r.reason for r in reject_reasons(rows, SPECS["child"], parents, AsOf(day(4))).collect()}
    assert reasons == {"1": "code shared", "2": "code shared", "3": "m_id missing", "4": "at in the future"}
