"""Merges into stored dimensions: overlapping ones, and what they read of the history."""

from __future__ import annotations

import datetime as dt
import random
import shutil

import pytest

from siltstone.operators.checks import overlapping_versions, state_difference, version_counts
from siltstone.operators.scd2 import ScdSpec, scd2_merge, split_versions
from siltstone.plans import loads
from siltstone.plans.dimensions import empty_dimension
from siltstone.sources import TableStore
from siltstone.sources.tables import ConcurrentWrite

SPEC = ScdSpec("dim_t", "t_sk", "k", ("v",), dt.datetime(2023, 1, 1))
PROFILE = "k string, v string, created_at timestamp_ntz, updated_at timestamp_ntz, source_system string"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "DIMENSIONS", {"dim_t": (SPEC, "t_profile")})
    return TableStore(spark, str(tmp_path))


@pytest.fixture
def profile(rows_of):
    return lambda *rows: rows_of(PROFILE, *[(k, v, None, None if n is None else day(n), "crm") for k, v, n in rows])


def versions(store):
    rows = store.read("gold.dim_t").collect()
    return sorted((r.k, r.v, r.effective_from, r.effective_to, r.is_current) for r in rows)


def overtaken(monkeypatch, store, times):
    """While a merge compares, another one of the same profile runs from start to end."""
    compare, left = loads.close_changed, [times]

    def first_the_other(*args):
        if left[0]:
            left[0] -= 1
            with monkeypatch.context() as plain:
                plain.setattr(loads, "close_changed", compare)
                loads.load_dimensions(store)
        return compare(*args)

    monkeypatch.setattr(loads, "close_changed", first_the_other)


def test_a_load_inside_another_loses_and_doubles_nothing(store, profile, monkeypatch):
    store.replace("silver.t_profile", profile(("1", "a", 1), ("2", "x", 1)))
    loads.load_dimensions(store)
    store.replace("silver.t_profile", profile(("1", "b", 5), ("2", "x", 1), ("3", "c", 5)))
    overtaken(monkeypatch, store, 1)
    results = loads.load_dimensions(store)
    found = versions(store)
    assert [(k, v, current) for k, v, _, _, current in found] == [
        ("1", "a", False), ("1", "b", True), ("2", "x", True), ("3", "c", True),
    ]
    # The other load did the work; this one found nothing left.
    assert (results["dim_t"]["new_versions"], results["dim_t"]["closed_versions"]) == (0, 0)
    rows = store.read("gold.dim_t")
    assert version_counts(rows, "k").where("NOT is_valid").count() == 0
    assert overlapping_versions(rows, "k").count() == 0


def test_a_load_that_is_always_overtaken_gives_up(store, profile, monkeypatch):
    store.replace("silver.t_profile", profile(("1", "a", 1)))
    overtaken(monkeypatch, store, 9)
    with pytest.raises(loads.PartlyFailed) as failure:
        loads.load_dimensions(store, attempts=2)
    assert isinstance(failure.value.errors["dim_t"], ConcurrentWrite)
    assert [v[:2] for v in versions(store)] == [("1", "a")]


def test_history_is_not_read(store, profile):
    """With the files of ended versions gone, loads still work."""
    for n in range(1, 4):
        store.replace("silver.t_profile", profile(("1", f"v{n}", n), ("2", "x", 1), ("4", "y", n)))
        loads.load_dimensions(store)
    ended = {p["dir"] for p in store.snapshot("gold.dim_t").parts if p["batch"] == loads.ENDED}
    assert len(ended) == 2
    for folder in ended:
        shutil.rmtree(f"{store.root}/gold.dim_t/{folder}")
    store.replace("silver.t_profile", profile(("1", "v9", 9), ("2", "x", 1), ("3", "new", 9)))
    done = loads.load_dimensions(store)["dim_t"]
    assert (done["new_versions"], done["closed_versions"]) == (2, 1)
    current = store.read("gold.dim_t", loads.CURRENT).collect()
    assert sorted((r.k, r.v) for r in current) == [("1", "v9"), ("2", "x"), ("3", "new"), ("4", "y")]


def test_loads_equal_the_rebuild_from_all_versions(store, profile, spark):
    """Random loads with shared, NULL and vanishing keys, some of which refer to ends of long ago."""
    rng = random.Random(3)
    expected = None
    for load in range(6):
        rows = [
            (rng.choice(["1", "2", "3", None, f"n{load}"]), rng.choice("ab"), rng.choice([None, *range(load * 2 + 3)]))
            for _ in range(9)
        ]
        now = profile(*rows)
        store.replace("silver.t_profile", now)
        before = expected if expected is not None else empty_dimension(now, SPEC)
        merged = scd2_merge(before, now, SPEC)
        expected = spark.createDataFrame(merged.collect(), merged.schema)
        loads.load_dimensions(store)
        assert state_difference(expected, store.read("gold.dim_t")).count() == 0, load
        assert split_versions(store.read("gold.dim_t", loads.CURRENT))[1].count() == 0


def test_parts_are_read_by_the_ends_they_hold(store, profile):
    """A row that shares its key and refers to an end of the second load needs that part and no other."""
    for n in range(1, 5):
        store.replace("silver.t_profile", profile(("1", f"v{n}", n)))
        loads.load_dimensions(store)
    parts = [p for p in store.snapshot("gold.dim_t").parts if p["batch"] == loads.ENDED]
    of = {p["spans"]["effective_to"][0][:10]: p["dir"] for p in parts}
    assert set(of) == {"2024-01-03", "2024-01-04", "2024-01-05"}
    for end, folder in of.items():
        if end != "2024-01-04":
            shutil.rmtree(f"{store.root}/gold.dim_t/{folder}")
    # The key is closed on day 9; its other row has the moment at which a version ended on day 3.
    store.replace("silver.t_profile", profile(("1", "w", 9), ("1", "u", 3)))
    assert loads.load_dimensions(store)["dim_t"]["shared_keys"] == 1
    current = store.read("gold.dim_t", loads.CURRENT).collect()
    assert sorted((r.v, r.effective_from) for r in current) == [("u", day(3)), ("w", day(9))]


def test_keys_with_ended_versions_only(store, profile, spark):
    """They can stand in a table that a full refresh wrote; they are known keys, in this load and in later ones."""
    store.replace("silver.t_profile", profile(("1", "a", 1)))
    loads.load_dimensions(store)
    rows = store.read("gold.dim_t")
    resting = rows.selectExpr("t_sk + 1 AS t_sk", "'2' AS k", "v", "effective_from", "timestamp_ntz'2024-01-06' AS effective_to",
                              "false AS is_current", "created_at", "updated_at", "source_system")
    both = rows.unionByName(resting)
    store.replace("gold.dim_t", spark.createDataFrame(both.collect(), both.schema))
    for changed, expected in ((4, 0), (4, 0), (5, 1)):
        store.replace("silver.t_profile", profile(("1", "a", 1), ("2", "b", changed)))
        assert loads.load_dimensions(store)["dim_t"]["new_versions"] == expected
    assert {p["batch"] for p in store.snapshot("gold.dim_t").parts} == {loads.CURRENT, loads.DORMANT}
