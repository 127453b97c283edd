from __future__ import annotations

import datetime as dt
import random

from siltstone.operators.asof import as_of_events

EVENTS, VERSIONS = "id bigint, k string, t timestamp_ntz", "k string, s timestamp_ntz, e timestamp_ntz, v bigint"


def at(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def found(events, versions, **options):
    rows = as_of_events(events, versions, "k", "t", "s", "e", "v", **options).collect()
    return sorted((r.id, r.v) for r in rows)


def test_by_comparing_every_pair(rows_of):
    rng = random.Random(1)
    events = [(i, rng.choice(["a", "a", "b", "c", None]), at(rng.choice([None, *range(60)]))) for i in range(300)]
    versions = []
    for v in range(60):
        begin = rng.randrange(60)
        versions.append((rng.choice(["a", "b", "d", None]), at(begin), rng.choice([None, at(begin + rng.randrange(20))]), v))
    expected = []
    for i, k, t in events:
        fits = [(s, v, e) for key, s, e, v in versions if None not in (k, t) and key == k and s <= t]
        if fits and (max(fits)[2] is None or t < max(fits)[2]):
            expected.append((i, max(fits)[1]))
    for buckets in (1, 3, 64):
        assert found(rows_of(EVENTS, *events), rows_of(VERSIONS, *versions), buckets=buckets) == sorted(expected)
    assert found(rows_of(EVENTS), rows_of(VERSIONS, *versions)) == found(rows_of(EVENTS, *events), rows_of(VERSIONS)) == []


def test_one_key_is_split_without_pairing(spark):
    """A million events and 100,000 versions of one key: no task of the windows holds much more than its share."""
    time = "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, {})"
    events = spark.range(1_000_000).selectExpr("id", "'k' AS k", f"{time.format('id')} AS t")
    versions = spark.range(100_000).selectExpr("'k' AS k", f"{time.format('id * 10')} AS s", "CAST(NULL AS timestamp_ntz) AS e", "id AS v")
    rows = as_of_events(events, versions, "k", "t", "s", "e", "v")
    wrong = rows.where("v <> id DIV 10")
    assert rows.count() == 1_000_000 and wrong.isEmpty()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
