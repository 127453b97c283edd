"""Rows that a watermark has passed over, against a plain comparison of both sides."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from siltstone.functions.dates import AsOf
from siltstone.operators.cleanse import TableSpec
from siltstone.operators.missed import bucket_digests, _newest, missed_changes
from siltstone.plans import loads
from siltstone.sources import TableStore

ROWS = "a bigint, b string, created_at timestamp_ntz, updated_at timestamp_ntz, source_system string"
UNTIL = dt.datetime(2024, 1, 20)
KEY = ("a", "b")


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def newest(rows, until=None):
    """By key; a key without a change time is older than all others."""
    found = {}
    for a, b, created, updated, _ in rows:
        times = [t for t in (created, updated) if t]
        at = max(times) if times else None
        if a is None or b is None or (until and at and at > until):
            continue
        found[a, b] = max(found.get((a, b), dt.datetime.min), at or dt.datetime.min)
    return found


def some(rng, size):
    return [
        (rng.choice([None, *range(12)]), rng.choice([None, "x", "y", ""]), rng.choice([None, day(rng.randrange(25))]),
         rng.choice([None, day(rng.randrange(25))]), "crm")
        for _ in range(size)
    ]


@pytest.mark.parametrize("buckets", [1, 7, 65536])
def test_against_a_plain_comparison(rows_of, buckets):
    rng = random.Random(buckets)
    source = some(rng, 60)
    bronze = rng.sample(source, 35) + some(rng, 10)
    found = missed_changes(rows_of(ROWS, *source), rows_of(ROWS, *bronze), KEY, UNTIL, buckets)
    held = newest(bronze)
    expected = {k for k, at in newest(source, UNTIL).items() if k not in held or at > held[k]}
    assert {(r.a, r.b) for r in found.collect()} == expected and found.count() == len(expected) > 0


def test_history_in_bronze_and_repeated_rows_make_no_difference(rows_of):
    source = [(1, "x", day(1), day(9), "crm"), (2, "x", None, None, "crm")]
    bronze = [(1, "x", day(1), None, "crm"), *source, *source]
    a, b = (bucket_digests(_newest(rows_of(ROWS, *r), KEY, 64), KEY) for r in (source, bronze))
    assert sorted(a.collect()) == sorted(b.collect())
    assert missed_changes(rows_of(ROWS, *source), rows_of(ROWS, *bronze), KEY, UNTIL).count() == 0


def test_empty_sides(rows_of):
    empty, one = rows_of(ROWS), rows_of(ROWS, (1, "x", None, day(3), "crm"))
    assert missed_changes(empty, one, KEY, UNTIL).count() == 0
    assert missed_changes(one, empty, KEY, UNTIL).collect() == [(1, "x", day(3), None)]


def test_late_rows_are_found_and_loaded_once(spark, rows_of, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "SPECS", {"t": TableSpec("t", ("a",), ("a", "b"))})
    store = TableStore(spark, str(tmp_path))
    given = rows_of(ROWS, (1, "x", day(1), None, "o"), (2, "y", day(5), None, "o")).drop("source_system")
    # Committed late: one row older than the watermark, one without any change time.
    late = rows_of(ROWS, (3, "z", day(2), day(4), "o"), (4, None, None, None, "o")).drop("source_system")
    newer = rows_of(ROWS, (5, "n", day(12), None, "o"), (6, "f", day(24), None, "o")).drop("source_system")
    now, source = AsOf(UNTIL), given.union(late).union(newer)
    loads.load_bronze_full(store, {"t": given}, now, "crm")
    loads.load_bronze_delta(store, {"t": source}, UNTIL, now, "crm")
    assert loads.load_missed(store, {"t": source}, UNTIL, now, "crm") == {"t": 2}
    assert sorted(r.a for r in store.read("bronze.t").collect()) == [1, 2, 3, 4, 5]
    assert loads.load_missed(store, {"t": source}, UNTIL, now, "crm") == {"t": 0}
