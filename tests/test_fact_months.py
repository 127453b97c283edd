"""Facts by month: only months whose rows differ are written, and the result equals a rebuild."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalog.registry import NOW, warehouse
from siltstone.functions.dates import AsOf
from siltstone.operators.checks import state_difference
from siltstone.operators.months import collected, differing, month_digests, within_months
from siltstone.plans import loads
from siltstone.plans.dimensions import DIMENSIONS
from siltstone.plans.facts import FACTS
from siltstone.plans.silver import SPECS
from siltstone.sources import TableStore

MET = "sk bigint, open bigint, period date, n bigint, _first date, _last date"


def stretches(rng, size):
    """Stretches of some days to some years; some begin after their active period, so its measure is of no account."""
    rows = []
    for _ in range(size):
        first = dt.date(2021, 11, 1) + dt.timedelta(rng.randrange(700))
        last = first + dt.timedelta(rng.choice([0, 3, 28, 31, 90, 400]))
        period = first - dt.timedelta(rng.choice([0, 0, 5]))
        rows.append((rng.choice([None, 1, 2]), rng.choice([None, 0, 1]), period, rng.choice([None, 1, 5]), first, last))
    return rows


def dense(rows):
    """The rows of each month, a day each."""
    months: dict[int, Counter] = {}
    for sk, open_, period, n, first, last in rows:
        for i in range((last - first).days + 1):
            day = first + dt.timedelta(i)
            months.setdefault(day.year * 100 + day.month, Counter())[sk, open_, day, n if day == period else None] += 1
    return months


def digests(rows_of, rows):
    return collected(month_digests(rows_of(MET, *rows), ("sk", "open"), ("n",)))


def test_digests_differ_where_rows_differ(rows_of):
    rng = random.Random(5)
    rows = stretches(rng, 60)
    before, first = dense(rows), digests(rows_of, rows)
    assert digests(rows_of, rng.sample(rows, len(rows))) == first
    for _ in range(4):
        changed = list(rows)
        for i in rng.sample(range(len(rows)), 2):
            changed[i] = stretches(rng, 1)[0]
        changed[rng.randrange(60)] = rows[0]
        after = dense(changed)
        found = differing(digests(rows_of, changed), first)
        assert found == sorted(m for m in after if after[m] != before.get(m))


def test_a_doubled_or_swapped_stretch_shows(rows_of):
    a = (1, 0, dt.date(2024, 1, 5), 1, dt.date(2024, 1, 5), dt.date(2024, 1, 9))
    b = (2, None, dt.date(2024, 1, 5), None, dt.date(2024, 1, 5), dt.date(2024, 1, 9))
    swapped = [(1, None, *a[2:]), (2, 0, *b[2:])]
    states = [digests(rows_of, x) for x in ([a, b], [a, a, b], [a, a, b, b], swapped, [a], [(*a[:3], 2, *a[4:]), b])]
    assert len({str(s) for s in states}) == len(states)
    assert digests(rows_of, []) == {}


def test_pieces_within_months(rows_of):
    rows = [(1, 0, dt.date(2023, 12, 30), 7, dt.date(2023, 12, 30), dt.date(2024, 3, 2))]
    found = within_months(rows_of(MET, *rows), [202312, 202402]).orderBy("_first").collect()
    assert [(r["_first"], r["_last"]) for r in found] == [
        (dt.date(2023, 12, 30), dt.date(2023, 12, 31)),
        (dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
    ]
    assert within_months(rows_of(MET, *rows), []).count() == 0


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    w = warehouse(spark, "/root/testdata/sf0.001")
    store = TableStore(spark, str(tmp_path_factory.mktemp("facts")))
    for t in SPECS:
        store.replace(f"silver.{t}", w.silver()[t])
    for d in DIMENSIONS:
        store.replace(f"gold.{d}", w.dimension(d))
    return store


def folders(store):
    return {f: {p["batch"]: p["dir"] for p in store.snapshot(f"gold.{f}").parts} for f in FACTS}


def equals_rebuild(store, as_of):
    silver = loads.silver_layer(store)
    for name, (fact, dimension, _, _) in FACTS.items():
        rebuilt = fact(silver, store.read(f"gold.{dimension}"), as_of)
        if state_difference(rebuilt, store.read(f"gold.{name}")).count():
            return False
    return True


def test_only_months_that_differ_are_written(store):
    first = loads.load_fact_months(store, NOW)
    assert equals_rebuild(store, NOW)
    assert all(r["written_rows"] == r["processed_record_count"] > 0 for r in first.values())

    before = folders(store)
    again = loads.load_fact_months(store, NOW)
    assert all(r["written_months"] == r["written_rows"] == 0 for r in again.values())
    assert folders(store) == before

    # Tickets of one month, in one fact only.
    tickets = store.read("silver.support_ticket")
    month = tickets.groupBy(F.date_format("opened_date", "yyyyMM")).count().orderBy(F.desc("count")).first()[0]
    store.replace("silver.support_ticket", tickets.where(F.date_format("opened_date", "yyyyMM") != month))
    done = loads.load_fact_months(store, NOW)
    assert {f: r["written_months"] for f, r in done.items()} == {
        "fact_customer_daily_activity": 1, "fact_content_monthly_performance": 0, "fact_inventory_daily_utilization": 0,
    }
    after = folders(store)
    assert {m for f in FACTS for m in after[f] if after[f][m] != before[f].get(m)} == {month}
    assert equals_rebuild(store, NOW)

    # A later day changes the running month and begins a new one; the calendar grows at its end.
    later = AsOf(dt.datetime(2024, 4, 2))
    done = loads.load_fact_months(store, later)
    assert 1 <= done["fact_customer_daily_activity"]["written_months"] <= 2
    assert equals_rebuild(store, later)

    # A table without digests is replaced whole, and one that becomes empty loses all its months.
    loads.load_facts(store, later)
    assert loads.load_fact_months(store, later)["fact_customer_daily_activity"]["written_months"] > 10
    assert equals_rebuild(store, later)
    store.replace("silver.customer", store.read("silver.customer").where("false"))
    assert loads.load_fact_months(store, later)["fact_customer_daily_activity"]["processed_record_count"] == 0
    assert equals_rebuild(store, later)
