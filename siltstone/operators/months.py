"""Which months of a dense fact differ from those on disk, told from its stretches and without its dense rows.

A stretch stands for a row per period, all alike but for the measures of its first one. A month's rows are therefore known
from the pieces of stretches that lie in it. Their hashes are summed up, so neither order nor files matter. A
stretch over many months has equal pieces in all but its first and last, and enters with the month in which these begin and
the one in which they end: running totals over months do the rest, and no stretch is cut into months for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SEEDS = (11, 29)
# Hashes are summed up in three parts of so many bits.
BITS = 22
Digests = dict[int, tuple[str, str]]


def month_number(day: Column) -> Column:
    """yyyymm, which is what ``date_key`` without its days is."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def _sums(hashed: str, name: str) -> list[Column]:
    """Sums of the signed low, middle and high bits, none of which can leave 64 bits below 2^41 rows."""
    value, low = F.col(hashed), F.lit((1 << BITS) - 1)
    cut = (value.bitwiseAND(low), F.shiftright(value, BITS).bitwiseAND(low), F.shiftright(value, 2 * BITS))
    return [F.sum(part * F.col("sign")).alias(f"{name}{i}") for i, part in enumerate(cut)]


def _whole(name: str) -> Column:
    """The sum of the hashes, from those of their bits."""
    parts = [F.col(f"{name}{i}").cast("decimal(20,0)") * F.lit(1 << BITS * i).cast("decimal(17,0)") for i in range(3)]
    return (parts[0] + parts[1] + parts[2]).cast("decimal(38,0)")


def month_digests(met: DataFrame, values: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``month, first, second``: two sums of hashes over all that lies in a month.

    ``met`` has stretches from ``_first`` to ``_last``, with ``values`` that hold throughout and ``measures`` that count if
    the stretch begins with its own ``period``. NULL differs from all values.
    """
    month, end_month = F.trunc("_first", "MM"), F.trunc("_last", "MM")
    own = F.col("period") == F.col("_first")

    def event(at: Column, first: Column, last: Column, measured: Column, onward: int) -> Column:
        """A piece from day ``first`` to ``last``: of a month (``onward`` 0), or of every month from this one on (1), no more (-1)."""
        fields = {"month": at, "first": first, "last": last, "measured": measured, "onward": F.lit(onward)}
        return F.struct(*[c.alias(name) for name, c in fields.items()])

    # Days of the month; whatever reaches its end looks alike, whether it goes on or not.
    start, finish, bare = F.lit(1), F.lit(31), F.lit(False)
    until = F.when(F.col("_last") < F.last_day("_last"), F.dayofmonth("_last")).otherwise(finish)
    several, many = month < end_month, F.add_months(month, 1) < end_month
    events = F.array(
        event(month, F.dayofmonth("_first"), F.when(several, finish).otherwise(until), own, 0),
        F.when(several, event(end_month, start, until, bare, 0)),
        F.when(many, event(F.add_months(month, 1), start, finish, bare, 1)),
        F.when(many, event(end_month, start, finish, bare, -1)),
    )
    seen = met.select(*values, *measures, F.explode(events).alias("_e")).where("_e IS NOT NULL")
    # Hashed after the array and summed up as whole numbers: functions of array elements and sums of decimals take many times as long.
    known = [*map(F.col, values), *[F.when(F.col("_e.measured"), F.col(c)) for c in measures]]
    parts = [x for c in (*known, F.col("_e.first"), F.col("_e.last")) for x in (c.isNull(), c)]
    at, sign = range(len(SEEDS)), F.when(F.col("_e.onward") < 0, -1).otherwise(1)
    hashed = seen.select(
        F.col("_e.month").alias("month"),
        (F.col("_e.onward") != 0).alias("onward"),
        sign.cast("bigint").alias("sign"),
        *[F.xxhash64(F.lit(seed), *parts).alias(f"hash{i}") for i, seed in enumerate(SEEDS)],
    )
    pieces = hashed.groupBy("month", "onward").agg(*[s for i in at for s in _sums(f"hash{i}", f"sum{i}_")])
    summed = pieces.groupBy("month").agg(
        *[
            F.sum(F.when(F.col("onward") == (part == "onward"), _whole(f"sum{i}_"))).alias(f"{part}{i}")
            for part in ("here", "onward")
            for i in at
        ]
    )
    # A row for each month that a stretch touches at an end; whole months between them are filled in.
    bounds = summed.agg(F.min("month").alias("low"), F.max("month").alias("high")).where("low IS NOT NULL")
    months = bounds.select(F.explode(F.sequence("low", "high", F.expr("INTERVAL '1' MONTH"))).alias("month"))
    # As many rows as the calendar has months, so one task may hold them.
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = [
        F.coalesce(F.col(f"here{i}"), F.lit(0)) + F.coalesce(F.sum(f"onward{i}").over(so_far), F.lit(0)) for i in at
    ]
    filled = months.join(summed, "month", "left")
    return filled.select(
        month_number(F.col("month")).alias("month"),
        *[t.cast("decimal(38,0)").cast("string").alias(name) for t, name in zip(totals, ("first", "second"), strict=True)],
    )


def collected(digests: DataFrame) -> Digests:
    """On the driver: a row for each month of the calendar."""
    return {r["month"]: (r["first"], r["second"]) for r in digests.collect()}


def differing(found: Digests, before: Mapping[int, tuple[str, str]]) -> list[int]:
    return sorted(m for m, digest in found.items() if before.get(m) != digest)


def within_months(met: DataFrame, months: Sequence[int]) -> DataFrame:
    """The pieces of stretches that lie in some months."""
    starts = F.sequence(F.trunc("_first", "MM"), F.trunc("_last", "MM"), F.expr("INTERVAL '1' MONTH"))
    wanted = F.filter(starts, lambda m: month_number(m).isin(list(months)))
    cut = met.withColumn("_month", F.explode(wanted))
    return (
        cut.withColumn("_first", F.greatest("_first", "_month"))
        .withColumn("_last", F.least("_last", F.last_day("_month")))
        .drop("_month")
    )
