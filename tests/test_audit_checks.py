from __future__ import annotations

import datetime as dt

import pytest

from siltstone.operators import audit
from siltstone.operators.checks import (
    overlapping_versions,
    repeated_grain,
    row_counts,
    state_difference,
    version_counts,
)

RUN = ("20240331", "silver", "run 1")
START, END = dt.datetime(2024, 3, 31, 1), dt.datetime(2024, 3, 31, 2)


def totals(spark, results):
    row = audit.roll_up(audit.task_results(spark, RUN, results)).first()
    return row.status, *[row[c] for c in audit.COUNTS]


def test_counts_and_mappings_add_up(spark):
    results = {"bronze": 7, "silver": audit.counts(source=10, processed=8), "partial": {"source_record_count": 1}}
    assert totals(spark, results) == ("Success", 18, 15, 15, 0, 2)


@pytest.mark.parametrize("odd", [None, "text", 3.5])
def test_a_missing_or_odd_result_fails_the_run(spark, odd):
    assert totals(spark, {"a": 7, "b": odd}) == ("Failed", 7, 7, 7, 0, 0)


def test_rejected_is_never_negative():
    assert audit.counts(source=3, processed=5)["rejected_record_count"] == 0
    assert audit.counts(source=5, processed=3)["rejected_record_count"] == 2


def test_open_and_close(spark):
    opened = audit.open_runs(audit.run_record(spark, *RUN, START)).unionByName(
        audit.open_runs(audit.run_record(spark, *RUN[:2], "run 2", START))
    )
    first = opened.first()
    assert (first.status, first.end_time, first.source_record_count) == ("Running", None, None)
    done = audit.roll_up(audit.task_results(spark, RUN, {"a": 7}))
    closed = {r.run_id: r for r in audit.close_runs(opened, done, END).collect()}
    assert (closed["run 1"].status, closed["run 1"].end_time) == ("Success", END)
    assert closed["run 1"].inserted_record_count == 7
    assert (closed["run 2"].status, closed["run 2"].end_time) == ("Running", None)
    assert closed["run 1"].audit_id != closed["run 2"].audit_id


def test_latest_runs(rows_of):
    runs = rows_of(
        "batch_id string, dag_id string, run_id string, start_time timestamp_ntz",
        *[(str(n), "a", str(n), START + dt.timedelta(days=n)) for n in range(8)],
        ("0", "b", "0", START),
    )
    found = audit.latest_runs(runs).collect()
    assert sorted((r.dag_id, r.run_rank, r.batch_id) for r in found) == [
        *[("a", n + 1, str(7 - n)) for n in range(5)],
        ("b", 1, "0"),
    ]


def test_metrics(rows_of):
    some, more = rows_of("a bigint", (1,)), rows_of("a bigint", (1,), (2,), (3,))
    assert tuple(audit.load_metrics("t", more, some).first()) == ("t", 3, 1, 1, 0, 2)
    assert tuple(audit.load_metrics("t", some, more).first()) == ("t", 1, 3, 3, 0, 0)
    assert tuple(audit.load_metrics("t", some.where("false"), some.where("false")).first()) == ("t", 0, 0, 0, 0, 0)


DIM = "k string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"


def span(k, a, b):
    day = lambda n: None if n is None else dt.datetime(2024, 1, n)
    return (k, day(a), day(b), b is None)


def test_version_checks(rows_of):
    dimension = rows_of(
        DIM,
        span("fine", 1, 5),
        span("fine", 5, None),
        span("inside", 1, 20),
        span("inside", 3, 5),
        span("inside", 6, 7),
        span("twice", 1, None),
        span("twice", 1, None),
        span("open", 1, None),
        span("open", 4, None),
    )
    overlaps = sorted((r.k, r.effective_from.day) for r in overlapping_versions(dimension, "k").collect())
    assert overlaps == [("inside", 3), ("inside", 6), ("open", 4), ("twice", 1)]
    counts = {r.k: (r.version_count, r.current_count, r.is_valid) for r in version_counts(dimension, "k").collect()}
    assert counts == {
        "fine": (2, 1, True),
        "inside": (3, 0, True),
        "twice": (2, 2, False),
        "open": (2, 2, False),
    }


def test_grain_and_counts(rows_of):
    fact = rows_of("sk bigint, d bigint", (1, 1), (1, 1), (1, 2), (None, 1), (None, 1))
    found = sorted((tuple(r) for r in repeated_grain(fact, ["sk", "d"]).collect()), key=str)
    assert found == [(1, 1, 2), (None, 1, 2)]
    counts = row_counts({("gold", "f"): fact, ("gold", "none"): fact.where("false")})
    assert sorted(tuple(r) for r in counts.collect()) == [("gold", "f", 5), ("gold", "none", 0)]


def test_state_difference_counts_copies(rows_of):
    before = rows_of("a bigint, b string", (1, "x"), (1, "x"), (2, None), (3, "z"))
    after = rows_of("a bigint, b string", (1, "x"), (2, None), (4, "w"))
    found = sorted(tuple(r) for r in state_difference(before, after).collect())
    assert found == [(1, "x", -1), (3, "z", -1), (4, "w", 1)]
    assert state_difference(before, before.orderBy("a")).count() == 0
