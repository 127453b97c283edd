from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltstone.sources.jdbc import depth_query, literal, range_predicates


def test_each_row_fulfils_one_predicate(spark):
    """A skewed column: nine rows of ten have one value, some have none. Ranges follow the content."""
    rows = spark.range(10_000).selectExpr("CASE WHEN id % 10 < 9 THEN 500 WHEN id % 7 = 0 THEN NULL ELSE id END AS k")
    bounds = rows.selectExpr(*[f"percentile_disc({i / 8}) WITHIN GROUP (ORDER BY k) AS b{i}" for i in range(1, 8)]).first()
    predicates = range_predicates("k", [b and int(b) for b in bounds])
    assert len(predicates) == len(set(predicates)) <= 9
    counts = rows.select(*[F.count_if(F.expr(p)) for p in predicates]).first()
    assert sum(counts) == 10_000 and counts[-1] == rows.where("k IS NULL").count()
    # The hot value begins a range; nothing else of size shares it.
    assert [p for p in predicates if p.startswith("k >= 500")]


def test_even_column(spark):
    rows = spark.range(1000).selectExpr("id AS k")
    bounds = rows.selectExpr(*[f"percentile_disc({i / 4}) WITHIN GROUP (ORDER BY k)" for i in range(1, 4)]).first()
    counts = rows.select(*[F.count_if(F.expr(p)) for p in range_predicates("k", map(int, bounds))]).first()
    assert max(counts) <= 251 and sum(counts) == 1000


def test_bounds_of_every_type():
    assert range_predicates("c", [None, None]) == ["c IS NOT NULL", "c IS NULL"]
    assert range_predicates("c", ["b'c", "a", "a"]) == ["c < 'a'", "c >= 'a' AND c < 'b''c'", "c >= 'b''c'", "c IS NULL"]
    assert literal(dt.datetime(2024, 1, 2, 3, 4, 5, 6)) == "TIMESTAMP '2024-01-02 03:04:05.000006'"
    assert (literal(dt.date(2024, 1, 2)), literal(Decimal("1.50")), literal(-3)) == ("DATE '2024-01-02'", "1.50", "-3")
    for odd in (None, True, 1.5, b"x"):
        with pytest.raises(TypeError):
            literal(odd)


def test_one_query_finds_the_bounds():
    assert depth_query("s.t", "k", 3) == (
        "SELECT percentile_disc(0.333333) WITHIN GROUP (ORDER BY k) AS b1,"
        " percentile_disc(0.666667) WITHIN GROUP (ORDER BY k) AS b2 FROM s.t"
    )
