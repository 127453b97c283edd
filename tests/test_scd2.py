from __future__ import annotations

import datetime as dt
import random

import pytest

from siltstone.operators.checks import overlapping_versions, state_difference, version_counts
from siltstone.operators.scd2 import OPEN_END, ScdSpec, scd2_changes, scd2_merge
from siltstone.plans.dimensions import empty_dimension

SPEC = ScdSpec("dim", "sk", "k", ("a", "b"), dt.datetime(2023, 1, 1))
PROFILE = "k string, a string, b string, created_at timestamp_ntz, updated_at timestamp_ntz, source_system string"
DIM = (
    "sk bigint, k string, a string, b string, effective_from timestamp_ntz, effective_to timestamp_ntz,"
    " is_current boolean, created_at timestamp_ntz, updated_at timestamp_ntz, source_system string"
)
BORN = dt.datetime(2022, 1, 1)


def at(n):
    return None if n is None else dt.datetime(2023, 1, 1) + dt.timedelta(days=n)


def source(k, a, updated, b="-"):
    return (k, a, b, BORN, at(updated), "S")


def version(k, a, start, end=None, b="-", sk=0):
    return (sk, k, a, b, at(start), OPEN_END if end is None else at(end), end is None, BORN, at(start), "S")


def state(df):
    """Versions as ``(key, a, from, to, current)`` with days since the anchor."""

    def day(t):
        return "open" if t == OPEN_END else (t - SPEC.anchor).days

    return sorted(
        ((r.k, r.a, day(r.effective_from), day(r.effective_to), r.is_current) for r in df.collect()),
        key=str,
    )


@pytest.fixture
def merge(rows_of):
    def run(dimension, profile, **options):
        return scd2_merge(rows_of(DIM, *dimension), rows_of(PROFILE, *profile), SPEC, **options)

    return run


def test_first_load_starts_at_the_anchor(rows_of):
    profile = rows_of(PROFILE, source("x", "1", 5), source("y", None, None))
    merged = scd2_merge(empty_dimension(profile, SPEC), profile, SPEC)
    assert state(merged) == [("x", "1", 0, "open", True), ("y", None, 0, "open", True)]
    assert merged.columns == list(SPEC.columns)


@pytest.mark.parametrize(
    "dimension, profile, expected, change",
    [
        # Nothing changed, though the source was touched.
        ([version("x", "1", 0)], [source("x", "1", 9)], [("x", "1", 0, "open", True)], "unchanged"),
        # A later change closes and opens at the source's time.
        (
            [version("x", "1", 0)],
            [source("x", "2", 9)],
            [("x", "1", 0, 9, False), ("x", "2", 9, "open", True)],
            "changed",
        ),
        # Not newer than the current version, or unknown when: ignored.
        ([version("x", "1", 5)], [source("x", "2", 5)], [("x", "1", 5, "open", True)], "stale"),
        ([version("x", "1", 5)], [source("x", "2", 3)], [("x", "1", 5, "open", True)], "stale"),
        ([version("x", "1", 5)], [source("x", "2", None)], [("x", "1", 5, "open", True)], "stale"),
        # NULL is a value.
        (
            [version("x", None, 0)],
            [source("x", "2", 9)],
            [("x", "2", 9, "open", True), ("x", None, 0, 9, False)],
            "changed",
        ),
        # A key that is gone stays as it is.
        (
            [version("x", "1", 0)],
            [source("y", "1", 9)],
            [("x", "1", 0, "open", True), ("y", "1", 0, "open", True)],
            "new",
        ),
        # No current version, but one that ended just when the source changed.
        (
            [version("x", "1", 0, 9)],
            [source("x", "1", 9)],
            [("x", "1", 0, 9, False), ("x", "1", 9, "open", True)],
            "unchanged",
        ),
        # No current version and no such end: nothing happens.
        ([version("x", "1", 0, 9)], [source("x", "2", 10)], [("x", "1", 0, 9, False)], "unchanged"),
    ],
)
def test_second_load(rows_of, merge, dimension, profile, expected, change):
    assert state(merge(dimension, profile)) == expected
    found = scd2_changes(rows_of(DIM, *dimension), rows_of(PROFILE, *profile), SPEC).collect()
    assert [r.change for r in found] == [change]


def test_unique_keys_rerun_to_the_same_state(merge, spark, rows_of):
    profile = rows_of(PROFILE, source("x", "2", 9), source("y", "1", 3))
    once = merge([version("x", "1", 0)], profile.collect())
    twice = scd2_merge(once, profile, SPEC)
    assert state_difference(once, twice).count() == 0
    assert version_counts(twice, "k").where("NOT is_valid").count() == 0
    assert overlapping_versions(twice, "k").count() == 0


def test_shared_keys_fan_out_then_close_each_other_once(merge):
    profile = [source("x", "1", 5), source("x", "2", 7)]
    first = merge([], profile)
    assert state(first) == [("x", "1", 0, "open", True), ("x", "2", 0, "open", True)]
    assert len({r.sk for r in first.collect()}) == 2
    second = merge(first.collect(), profile)
    # Each version meets the other row: "1" ends when "2" changed, and vice versa.
    assert state(second) == [
        ("x", "1", 0, 7, False),
        ("x", "1", 5, "open", True),
        ("x", "2", 0, 5, False),
        ("x", "2", 7, "open", True),
    ]


def test_duplicate_rules(merge):
    profile = [source("x", "1", 5), source("x", "2", 7), source(None, "n", 1), source(None, "n", 1)]
    assert len(merge([], profile, on_duplicate="keep_all").collect()) == 4
    latest = state(merge([], profile, on_duplicate="latest"))
    assert latest == [("x", "2", 0, "open", True), (None, "n", 0, "open", True), (None, "n", 0, "open", True)]
    with pytest.raises(Exception, match="more than one source row for x"):
        merge([], profile, on_duplicate="fail").collect()
    assert len(merge([], profile[1:], on_duplicate="fail").collect()) == 3
    with pytest.raises(ValueError):
        merge([], profile, on_duplicate="other")


def test_rows_without_a_key_are_inserted_each_time(merge):
    profile = [source(None, "1", 5)]
    assert len(merge(merge([], profile).collect(), profile).collect()) == 2


def by_definition(dimension, profile):
    """Close, insert new keys, insert new versions: one after another, row by row."""
    rows = [list(r) for r in dimension]
    K, A, B, FROM, TO, CUR, UPD = 1, 2, 3, 4, 5, 6, 8
    for r in rows:
        later = [
            s[4]
            for s in profile
            if s[0] is not None and s[0] == r[K] and r[CUR] and s[4] and s[4] > r[FROM] and (s[1], s[2]) != (r[A], r[B])
        ]
        if later:
            r[TO], r[CUR], r[UPD] = max(later), False, max(later)
    before = [list(r) for r in rows]

    def same_key(s):
        return [r for r in before if s[0] is not None and r[K] == s[0]]

    for s in profile:
        known = same_key(s)
        if not known:
            start = SPEC.anchor
        elif not any(r[CUR] for r in known) and any(not r[CUR] and s[4] and r[TO] == s[4] for r in known):
            start = s[4]
        else:
            continue
        rows.append([0, s[0], s[1], s[2], start, OPEN_END, True, s[3], s[4], s[5]])
    return sorted((tuple(r[1:]) for r in rows), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_random_loads_follow_the_definition(spark, rows_of, seed):
    """Shared keys included; a third of all source rows has the same key."""
    rng = random.Random(seed)

    def profile():
        return [
            source(
                "hot" if rng.random() < 0.34 else rng.choice(["p", "q", "r", "s", None]),
                rng.choice(["1", "2", None]),
                rng.choice([None, *range(0, 12)]),
                rng.choice(["-", "+"]),
            )
            for _ in range(rng.randint(1, 14))
        ]

    dimension = []
    for _ in range(3):
        rows = profile()
        merged = scd2_merge(rows_of(DIM, *dimension), rows_of(PROFILE, *rows), SPEC).collect()
        assert sorted((tuple(r)[1:] for r in merged), key=str) == by_definition(dimension, rows)
        dimension = [tuple(r) for r in merged]


def test_ended_versions_are_shuffled_only_as_keys_and_ends(spark, rows_of, tmp_path):
    rows_of(DIM, version("x", "a", 0, 5), version("x", "b", 5)).write.parquet(str(tmp_path / "d"))
    dimension = spark.read.parquet(str(tmp_path / "d"))
    merged = scd2_merge(dimension, rows_of(PROFILE, source("x", "c", 9)), SPEC)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    # Attributes of ended versions pass through the union, beside joins and aggregates.
    assert plan.startswith("Union")
    first = plan.split("+- ")[1] if "+- " in plan else plan
    assert "Join" not in plan[: plan.index("Relation")] and "Aggregate" not in first
