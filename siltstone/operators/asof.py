"""As-of lookup of dimension versions, done per entity and not per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from siltstone.operators.calendar import previous, spine, truncate


def version_spans(
    bounded: DataFrame, dimension: DataFrame, business_key: str, version: str, step: str
) -> DataFrame:
    """Cut each entity's spine into the stretches that one version owns.

    A period belongs to the version valid at its last microsecond. On whole
    periods that is the range from the period of ``effective_from`` to the one
    before the period of ``effective_to`` (open if NULL), so the lookup is an
    equi join of entities with versions and periods are expanded later.
    Entities without a valid version vanish, as from any inner join.
    """
    versions = dimension.select(
        business_key,
        version,
        truncate(F.col("effective_from"), step).alias("_from"),
        previous(truncate(F.col("effective_to"), step), step).alias("_to"),
    )
    return (
        bounded.join(versions, business_key)
        .withColumn("first_period", F.greatest("first_period", "_from"))
        .withColumn("last_period", F.least("last_period", "_to"))
        .where("first_period <= last_period")
        .drop("_from", "_to")
    )


def as_of_join(
    bounded: DataFrame,
    dimension: DataFrame,
    business_key: str,
    version: str,
    step: str,
    period: str,
) -> DataFrame:
    """Spine rows with the version valid at the end of each period."""
    return spine(version_spans(bounded, dimension, business_key, version, step), step, period)


def as_of_events(
    events: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    version: str,
    buckets: int = 64,
) -> DataFrame:
    """Each event with the version of its key that started last before it (or then), unless that has ended; others vanish.

    Events and versions are never paired, and one key may hold most of both. Their times are cut into ``buckets`` ranges
    of like content. Within a key's range the last version so far is carried along; what a range ends with
    is carried over the key's later ranges, of which there are ``buckets`` at most, and fills in where a range begins. So no
    group is larger than a range. Of versions that start at once the one with the largest ``version`` counts.
    """
    marks = versions.select(
        F.col(key).alias("_key"), F.col(start).alias("_at"), F.struct(version, F.col(end).alias("_end")).alias("_mark")
    )
    rows = events.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.struct("*").alias("_event"))
    both = marks.unionByName(rows, allowMissingColumns=True).where("_key IS NOT NULL AND _at IS NOT NULL")
    cuts = [i / buckets for i in range(1, buckets)]
    # Times as numbers, which is what percentiles are made of; a cut needs no precision.
    number = F.unix_micros(F.col("_at").cast("timestamp"))
    bounds = sorted(set(both.agg(F.percentile_approx(number, cuts, 1000)).first()[0] or ()))
    bucket = F.lit(0)
    for bound in bounds:
        bucket = bucket + (number > bound).cast("int")
    both = both.withColumn("_bucket", bucket)
    # Versions come before the events of their moment.
    in_order = Window.partitionBy("_key", "_bucket").orderBy("_at", F.col("_event").isNotNull(), "_mark")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = both.withColumn("_here", F.last("_mark", ignorenulls=True).over(so_far)).where("_event IS NOT NULL")
    newest = F.max(F.when(F.col("_mark").isNotNull(), F.struct("_at", "_mark")))["_mark"]
    tails = both.groupBy("_key", "_bucket").agg(newest.alias("_tail"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumn("_before", F.last("_tail", ignorenulls=True).over(before)).drop("_tail")
    found = within.join(carried, ["_key", "_bucket"]).withColumn("_found", F.coalesce("_here", "_before"))
    valid = F.col("_found._end").isNull() | (F.col("_at") < F.col("_found._end"))
    return found.where(F.col("_found").isNotNull() & valid).select("_event.*", F.col(f"_found.{version}").alias(version))
