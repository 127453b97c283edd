"""Dense periodic snapshots from sparse activity.

A dense fact has a row for each entity and period, most of them without any
activity. Joining measures to the exploded spine would shuffle and sort all of
those rows once per measure. Here only active periods move: they are summed
per entity and period, each learns where the next one starts, and the result
meets the version spans on the entity. Exploding the stretches is the last
step before the write, and the dense rows are never shuffled.

Per entity, the largest group anywhere is its number of active periods, which
the calendar bounds; repeated activity collapses before the first shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltstone.operators.calendar import partitions, previous, spread, steps


def contribution(
    source: DataFrame, entity: str, period: Column, measures: dict[str, Column]
) -> DataFrame:
    """Rows ``(entity, period, measures...)`` that one source adds."""
    return source.select(
        F.col(entity), period.alias("period"), *[m.alias(n) for n, m in measures.items()]
    ).where(F.col("period").isNotNull())


def sum_contributions(
    parts: Sequence[DataFrame], entity: str, measures: Sequence[str]
) -> DataFrame:
    """Add all sources up in one shuffle; a measure a source lacks stays NULL."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(entity, "period").agg(*[F.sum(m).alias(m) for m in measures])


def stretches(
    bounded: DataFrame,
    parts: Sequence[DataFrame],
    entity: str,
    measures: Sequence[str],
    carried: Sequence[str] = (),
) -> DataFrame:
    """One row per entity and active period, with the start of the next one.

    The first spine period counts as active, so each entity has a stretch that
    covers its start. ``carried`` columns become running totals, which hold
    until the next active period.
    """
    starts = bounded.select(entity, F.col("first_period").alias("period"))
    summed = sum_contributions([starts, *parts], entity, [*measures, *carried])
    by_period = Window.partitionBy(entity).orderBy("period")
    so_far = by_period.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return summed.withColumns(
        {
            "next_period": F.lead("period").over(by_period),
            **{c: F.coalesce(F.sum(c).over(so_far), F.lit(0)) for c in carried},
        }
    )


def densify(
    spans: DataFrame,
    active: DataFrame,
    entity: str,
    step: str,
    period: str,
    measures: Sequence[str],
    carried: Sequence[str] = (),
    cluster_by_month: bool = False,
    choose: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Expand stretches over the spans; measures count in their own period only.

    ``choose`` may leave out or cut stretches (``_first`` to ``_last``) before they are expanded.

    ``cluster_by_month`` brings the rows of a month together. Stretches are cut
    at month ends and range-partitioned before they are expanded; the entity
    takes part in the ranges, so a full month spreads over several tasks.
    """
    first = F.greatest("first_period", "period")
    last = F.least("last_period", previous(F.col("next_period"), step))
    overlap = (F.col("period") <= F.col("last_period")) & (
        F.col("next_period").isNull() | (F.col("next_period") > F.col("first_period"))
    )
    kept = [c for c in spans.columns if c not in ("first_period", "last_period")]
    met = (
        spans.join(active, entity)
        .where(overlap)
        .select(*kept, "period", *measures, *carried, first.alias("_first"), last.alias("_last"))
    )
    if choose:
        met = choose(met)
    if cluster_by_month:
        months = steps(F.trunc("_first", "MM"), F.trunc("_last", "MM"), "month")
        met = (
            met.withColumn("_month", F.explode(months))
            .withColumn("_first", F.greatest("_first", "_month"))
            .withColumn("_last", F.least("_last", F.last_day("_month")))
        )
        met = met.repartitionByRange(partitions(met), "_month", entity)
    else:
        # Above the join, so that it can be split and coalesced as its sides turn out.
        met = spread(met, entity, "_first")
    expanded = met.withColumn(period, F.explode(steps(F.col("_first"), F.col("_last"), step)))
    own_period = F.col(period) == F.col("period")
    return expanded.select(
        *kept, period, *[F.when(own_period, F.col(m)).alias(m) for m in measures], *carried
    )
