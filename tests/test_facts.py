from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltstone.functions.dates import AsOf, Calendar
from siltstone.operators.asof import as_of_join
from siltstone.operators.calendar import DAY, MONTH, dim_date, spanning, spine, spine_bounds, spine_size
from siltstone.plans import facts

NOW = AsOf(dt.datetime(2023, 3, 10, 12))
OPEN = dt.datetime(9999, 12, 31, 23, 59, 59)


def day(n, month=1):
    return dt.date(2023, month, n)


def moment(n, *clock):
    return dt.datetime(2023, 1, n, *clock)


def test_calendar(spark):
    days = dim_date(spark, Calendar(dt.date(2023, 12, 30), dt.date(2024, 1, 2)))
    assert [tuple(r) for r in days.orderBy("date_key").collect()] == [
        (20231230, dt.date(2023, 12, 30), 30),
        (20231231, dt.date(2023, 12, 31), 31),
        (20240101, dt.date(2024, 1, 1), 1),
        (20240102, dt.date(2024, 1, 2), 2),
    ]


@pytest.mark.parametrize("step", [DAY, MONTH])
def test_spine_bounds_size_and_calendar_edges(rows_of, step):
    entities = rows_of(
        "id bigint, start date",
        (1, day(1)),
        (2, day(1, 3)),
        (3, day(1, 4)),
        (4, dt.date(2012, 12, 1)),
    )
    bounded = spine_bounds(entities, F.col("start"), NOW, step)
    assert spanning(NOW, bounded) == Calendar(dt.date(2012, 12, 1), NOW.ts.date())
    assert spanning(NOW, bounded.where("false")) == Calendar(NOW.ts.date(), NOW.ts.date())
    rows = spine(bounded, step, "p").collect()
    assert spine_size(bounded, step).first()[0] == len(rows)
    found = {}
    for r in rows:
        found.setdefault(r.id, []).append(r.p)
    assert 3 not in found
    if step == DAY:
        assert len(found[1]) == 69 and len(found[2]) == 10 and min(found[4]) == dt.date(2012, 12, 1)
    else:
        assert sorted(found[1]) == [day(1), day(1, 2), day(1, 3)]
        assert len(found[4]) == 10 * 12 + 4


def test_a_spine_beyond_its_calendar_is_an_error(rows_of):
    entities = rows_of("id bigint, start date", (1, day(1)), (2, day(9)))
    start, last = F.col("start"), NOW.ts.date()
    fits = spine_bounds(entities, start, NOW, DAY, Calendar(day(1), last))
    assert fits.count() == 2
    with pytest.raises(ValueError, match="ends on"):
        spine_bounds(entities, start, NOW, DAY, Calendar(day(1), day(9, 3)))
    with pytest.raises(Exception, match="begins on 2023-01-02, after 2023-01-01"):
        spine_bounds(entities, start, NOW, DAY, Calendar(day(2), last)).collect()


def test_missing_starts_use_the_fallback(rows_of):
    silver = {
        "customer": rows_of(
            "customer_id bigint, customer_no string, registration_date date", (1, "a", None)
        ),
        "content": rows_of("content_id bigint, release_date date", (1, dt.date(2019, 5, 7)), (2, None), (3, day(20, 2))),
    }
    assert facts.customer_days(silver, NOW).first().first_period == day(1)
    starts = {r.content_id: r.first_period for r in facts.content_months(silver, NOW).collect()}
    assert starts == {1: day(1), 2: day(1), 3: day(1, 2)}


VERSIONS = "k string, sk bigint, effective_from timestamp_ntz, effective_to timestamp_ntz"


@pytest.mark.parametrize("cut", [(5,), (5, 12), (5, 23, 59, 59, 999999), (6,)])
def test_the_version_at_the_end_of_the_day_owns_the_day(rows_of, cut):
    split = moment(*cut)
    dimension = rows_of(VERSIONS, ("a", 1, moment(1), split), ("a", 2, split, None))
    bounded = rows_of("k string, first_period date, last_period date", ("a", day(1), day(9)))
    found = {r.d: r.sk for r in as_of_join(bounded, dimension, "k", "sk", DAY, "d").collect()}
    expected = {}
    for n in range(1, 10):
        end = moment(n) + dt.timedelta(days=1) - dt.timedelta(microseconds=1)
        expected[day(n)] = 1 if end < split else 2
    assert found == expected


@pytest.mark.parametrize("cut", [dt.datetime(2023, 2, 1), dt.datetime(2023, 2, 14), dt.datetime(2023, 2, 28, 23, 59, 59, 999999)])
def test_the_version_at_the_end_of_the_month_owns_the_month(rows_of, cut):
    dimension = rows_of(VERSIONS, ("a", 1, moment(1), cut), ("a", 2, cut, OPEN))
    bounded = rows_of("k string, first_period date, last_period date", ("a", day(1), day(1, 4)))
    found = {r.d.month: r.sk for r in as_of_join(bounded, dimension, "k", "sk", MONTH, "d").collect()}
    expected = {}
    for m in range(1, 5):
        end = dt.datetime(2023, m + 1, 1) - dt.timedelta(microseconds=1)
        expected[m] = 1 if end < cut else 2
    assert found == expected


def test_days_before_the_first_version_are_lost(rows_of):
    dimension = rows_of(VERSIONS, ("a", 1, moment(5), OPEN))
    bounded = rows_of(
        "k string, first_period date, last_period date", ("a", day(1), day(9)), ("b", day(1), day(9))
    )
    days = [r.d for r in as_of_join(bounded, dimension, "k", "sk", DAY, "d").collect()]
    assert sorted(days) == [day(n) for n in range(5, 10)]


RENTAL = "rental_id bigint, customer_id bigint, inventory_id bigint, rental_date date, return_date date"
ITEM = "inventory_id bigint, barcode string, purchase_date date, content_id bigint"
ITEM_DIM = "barcode string, inventory_sk bigint, effective_from timestamp_ntz, effective_to timestamp_ntz"


def test_occupancy_of_special_rentals(rows_of):
    silver = {
        "inventory_item": rows_of(ITEM, *[(i, f"B{i}", day(1, 3), 1) for i in range(1, 7)]),
        "rental": rows_of(
            RENTAL,
            (1, 1, 1, day(3, 3), day(3, 3)),  # back on the same day: never utilised
            (2, 1, 2, day(3, 3), None),  # still out
            (3, 1, 3, day(3, 3), day(6, 3)),
            (4, 1, 3, day(5, 3), day(8, 3)),  # overlaps
            (5, 1, 4, day(1, 2), day(3, 3)),  # from before the purchase
            (6, 1, 5, day(2, 3), day(20, 3)),  # back after today
        ),
    }
    found = {}
    for r in facts.inventory_status(silver, NOW).where("is_utilised = 1").collect():
        found.setdefault(r.inventory_id, []).append(r.full_date.day)
    assert {k: sorted(v) for k, v in found.items()} == {
        2: list(range(3, 11)),
        3: [3, 4, 5, 6, 7],
        4: [1, 2],
        5: list(range(2, 11)),
    }


@pytest.mark.parametrize("cluster", [False, True])
@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("calendar", [None, Calendar(dt.date(2023, 1, 1), dt.date(2024, 1, 1))])
def test_inventory_fact_follows_the_definition(rows_of, seed, cluster, calendar):
    """Every item and day by brute force; a third of the rentals is of one item."""
    rng = random.Random(seed)
    items = [
        (i, f"B{i % 5}", None if i == 3 else day(rng.randint(1, 28)), 1) for i in range(1, 8)
    ]
    rentals = []
    for n in range(60):
        start = day(1) + dt.timedelta(days=rng.randint(-20, 75))
        back = None if rng.random() < 0.05 else start + dt.timedelta(days=rng.randint(-1, 9))
        rentals.append((n, 1, 1 if n % 3 == 0 else rng.randint(1, 7), start, back))
    cut = moment(rng.randint(2, 28), rng.randint(0, 23))
    versions = [(f"B{i}", i, moment(1), OPEN) for i in range(4) if i != 1]
    versions += [("B1", 10, moment(1), cut), ("B1", 11, cut, None), ("B1", 12, moment(9), OPEN)]
    silver = {"inventory_item": rows_of(ITEM, *items), "rental": rows_of(RENTAL, *rentals)}
    fact = facts.fact_inventory_daily_utilization(
        silver, rows_of(ITEM_DIM, *versions), NOW, calendar, cluster
    )
    expected = []
    for i, barcode, bought, _ in items:
        d = bought or day(1)
        while d <= NOW.ts.date():
            end = dt.datetime.combine(d, dt.time.max)
            own = [r for r in rentals if r[2] == i]
            out = sum(r[3] == d for r in own)
            back = sum(r[4] == d for r in own)
            busy = any(r[3] <= d and (r[4] is None or r[4] > d) for r in own)
            for b, sk, start, stop in versions:
                if b == barcode and start <= end and (stop is None or end < stop):
                    key = int(d.strftime("%Y%m%d"))
                    expected.append((sk, key, out, back, 0 if busy else 1, 100.0 if busy else 0.0))
            d += dt.timedelta(days=1)
    found = [(*tuple(r)[:5], float(r[5])) for r in fact.collect()]
    assert sorted(found) == sorted(expected)


def test_customer_fact_measures(rows_of):
    silver = {
        "customer": rows_of(
            "customer_id bigint, customer_no string, registration_date date", (1, "a", day(8, 3)), (2, "b", day(9, 3))
        ),
        "streaming_session": rows_of(
            "customer_id bigint, start_time timestamp_ntz, watch_duration int",
            (1, dt.datetime(2023, 3, 9, 23, 59), 5),
            (1, dt.datetime(2023, 3, 9, 1), None),
            (1, dt.datetime(2023, 3, 1), 7),
        ),
        "rental": rows_of(RENTAL, (1, 2, 1, day(10, 3), None), (2, 2, 1, day(1, 3), day(10, 3))),
        "payment": rows_of(
            "customer_id bigint, payment_date timestamp_ntz, amount decimal(18,2), status string",
            (1, dt.datetime(2023, 3, 10, 5), Decimal(2), "COMPLETED"),
            (1, dt.datetime(2023, 3, 10, 6), Decimal(3), "COMPLETED"),
            (1, dt.datetime(2023, 3, 10, 6), Decimal(9), "FAILED"),
        ),
        "support_ticket": rows_of(
            "customer_id bigint, opened_date timestamp_ntz", (2, dt.datetime(2023, 3, 9, 4))
        ),
    }
    dimension = rows_of(
        "customer_no string, customer_sk bigint, effective_from timestamp_ntz, effective_to timestamp_ntz",
        ("a", 1, moment(1), OPEN),
        ("b", 2, moment(1), OPEN),
    )
    fact = facts.fact_customer_daily_activity(silver, dimension, NOW)
    found = sorted((*tuple(r)[:6], float(r[6]), r[7]) for r in fact.collect())
    assert found == [
        (1, 20230308, 0, 0, 0, 0, 0.0, 0),
        (1, 20230309, 2, 5, 0, 0, 0.0, 0),
        (1, 20230310, 0, 0, 0, 0, 5.0, 0),
        (2, 20230309, 0, 0, 0, 0, 0.0, 1),
        (2, 20230310, 0, 0, 1, 1, 0.0, 0),
    ]


def test_unrated_months_have_rating_zero(rows_of):
    month = dt.datetime(2023, 2, 3)
    silver = {
        "content": rows_of("content_id bigint, release_date date", (1, day(5))),
        "streaming_session": rows_of("content_id bigint, start_time timestamp_ntz", (1, month)),
        "inventory_item": rows_of(ITEM, (7, "B", None, 1)),
        "rental": rows_of(RENTAL, (1, 1, 7, day(3, 2), None), (2, 1, 7, day(4, 2), None)),
        "payment": rows_of(
            "rental_id bigint, payment_date timestamp_ntz, amount decimal(18,2), status string",
            (1, dt.datetime(2023, 3, 1), Decimal(4), "COMPLETED"),
            (2, dt.datetime(2023, 3, 1), Decimal(5), "COMPLETED"),
            (None, dt.datetime(2023, 3, 1), Decimal(6), "COMPLETED"),
        ),
        "review": rows_of(
            "content_id bigint, rating decimal(10,3), review_date timestamp_ntz", (1, Decimal("4.005"), month), (1, Decimal(5), month)
        ),
        "wishlist": rows_of("content_id bigint, added_date timestamp_ntz", (1, month)),
    }
    dimension = rows_of(
        "content_id bigint, content_sk bigint, effective_from timestamp_ntz, effective_to timestamp_ntz",
        (1, 9, moment(1), OPEN),
    )
    fact = facts.fact_content_monthly_performance(silver, dimension, NOW)
    assert sorted((r[1], r[2], r[3], float(r[4]), r[5], r[6]) for r in fact.collect()) == [
        (20230101, 0, 0, 0.0, 0.0, 0),
        (20230201, 1, 2, 0.0, 4.5025, 1),
        (20230301, 0, 0, 9.0, 0.0, 0),
    ]
