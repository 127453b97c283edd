from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from siltstone.functions import (
    blank_to_null,
    lower_text,
    surrogate_key,
    title_text,
    upper_code,
    whole_years,
)
from siltstone.functions.dates import AsOf


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_text(rows_of):
    df = rows_of("t string", (" a ",), ("",), ("   ",), ("\ta",), (" a",), (None,))
    assert values(df, blank_to_null(F.col("t"))) == ["a", None, None, "\ta", " a", None]
    assert values(df, upper_code(F.col("t")))[0] == "A"
    assert values(df, lower_text(F.lit("  Ab@C "))) [0] == "ab@c"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("sci-fi o'neil", "Sci-Fi O'Neil"),
        (" 10TH x_y ", "10th X_Y"),
        ("ÉTÉ à paris", "Été À Paris"),
        ("  ", None),
    ],
)
def test_title(spark, text, expected):
    assert spark.range(1).select(title_text(F.lit(text))).first()[0] == expected


@pytest.mark.parametrize(
    "born, on, age",
    [
        ("2000-02-29", "2001-02-28", 0),
        ("2000-02-29", "2001-03-01", 1),
        ("1990-05-10", "2024-05-09", 33),
        ("1990-05-10", "2024-05-10", 34),
        ("1990-05-10", "2024-05-11", 34),
    ],
)
def test_age(spark, born, on, age):
    day = lambda d: F.lit(dt.date.fromisoformat(d))
    assert spark.range(1).select(whole_years(day(born), day(on))).first()[0] == age


def test_surrogate_key_is_stable_and_tells_nulls_apart(rows_of):
    df = rows_of("a string, b string", ("x", None), (None, "x"), ("x", None))
    one, two, three = values(df, surrogate_key(F.col("a"), F.col("b")))
    assert one == three != two


@given(st.lists(st.lists(st.sampled_from([None, "", "a", "|", "N", "~", "1:", ":", "a|1:b"]), min_size=2, max_size=2), min_size=2, max_size=40))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_surrogate_keys_are_equal_only_for_equal_values(rows_of, pairs):
    df = rows_of("a string, b string", *map(tuple, pairs))
    keys = values(df, surrogate_key(F.col("a"), F.col("b")))
    assert len(set(keys)) == len(set(map(tuple, pairs)))


def test_literals_do_not_depend_on_the_session_time_zone(spark):
    as_of = AsOf(dt.datetime(2024, 3, 10, 2, 30))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = set()
        for z in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            row = spark.range(1).select(as_of.timestamp.alias("t")).select(
                surrogate_key(F.lit("k"), F.col("t")), F.col("t").cast("string")
            )
            found.add(tuple(row.first()))
        assert len(found) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
