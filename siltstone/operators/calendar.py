"""Dense calendars and per-entity spines, without a range join.

A join of entities with a date table on ``>=`` and ``<=`` has no equality to
hash on, and Spark would compare each entity with each date. With a gap-free
calendar the same rows come from one ``sequence`` per entity: no comparison, and
the work is proportional to the output, spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.functions.dates import AsOf, Calendar, date_key

DAY = "day"
MONTH = "month"


def steps(first: Column, last: Column, step: str) -> Column:
    """Period starts from ``first`` to ``last``; callers ensure first <= last."""
    return F.sequence(first, last, F.expr(f"INTERVAL '1' {step.upper()}"))


def previous(period: Column, step: str) -> Column:
    return F.date_sub(period, 1) if step == DAY else F.add_months(period, -1)


def truncate(moment: Column, step: str) -> Column:
    """The start of the period that holds ``moment``, as a date."""
    return F.to_date(moment) if step == DAY else F.trunc(moment, "MM")


def dim_date(spark: SparkSession, calendar: Calendar) -> DataFrame:
    days = (calendar.last - calendar.first).days + 1
    day = F.date_add(F.lit(calendar.first), F.col("id").cast("int"))
    return (
        spark.range(days)
        .select(day.alias("full_date"))
        .select(
            date_key(F.col("full_date")).alias("date_key"),
            "full_date",
            F.dayofmonth("full_date").alias("day"),
        )
    )


def spine_bounds(
    entities: DataFrame, start: Column, as_of: AsOf, step: str, calendar: Calendar | None = None
) -> DataFrame:
    """Add ``first_period`` and ``last_period``; entities without any are dropped.

    A spine is as long as the data says. With a ``calendar`` it must lie within it: a
    period that the calendar lacks would be missing from a fact without a word.
    """
    last = as_of.ts.date()
    if calendar and last > calendar.last:
        raise ValueError(f"the calendar ends on {calendar.last}, before {last}")
    if step == MONTH:
        last = last.replace(day=1)
    if calendar:
        first = calendar.first.replace(day=1) if step == MONTH else calendar.first
        message = F.concat(
            F.lit(f"the calendar begins on {calendar.first}, after "), start.cast("string")
        )
        start = F.when(start < F.lit(first), F.raise_error(message).cast("date")).otherwise(start)
    return (
        entities.withColumn("first_period", start)
        .withColumn("last_period", F.lit(last))
        .where("first_period <= last_period")
    )


def spanning(as_of: AsOf, *spines: DataFrame) -> Calendar:
    """The shortest calendar that holds all spines up to ``as_of``: one least start for each."""
    starts = [s.agg(F.min("first_period")).first()[0] for s in spines]
    last = as_of.ts.date()
    return Calendar(min((d for d in starts if d), default=last), last)


def partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Hash rows into as many partitions as the session shuffles into.

    What follows expands each row into many. A fixed number of partitions
    keeps adaptive execution from packing the rows by their size before that.
    """
    return rows.repartition(partitions(rows), *keys)


def spine(bounded: DataFrame, step: str, period: str) -> DataFrame:
    """One row per entity and period."""
    return spread(bounded, *bounded.columns).withColumn(
        period, F.explode(steps(F.col("first_period"), F.col("last_period"), step))
    ).drop("first_period", "last_period")


def spine_size(bounded: DataFrame, step: str) -> DataFrame:
    """The number of spine rows, computed from the bounds alone."""
    first, last = F.col("first_period"), F.col("last_period")
    if step == DAY:
        length = F.datediff(last, first) + 1
    else:
        length = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1
    return bounded.agg(F.coalesce(F.sum(length), F.lit(0)).cast("bigint").alias("expected_rows"))
