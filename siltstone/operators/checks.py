"""Warehouse checks. Each returns the offending rows, or counts, as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F


def repeated_grain(fact: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Grain values that occur more than once."""
    counted = fact.groupBy(*grain).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where("row_count > 1")


def version_counts(dimension: DataFrame, key: str) -> DataFrame:
    """Versions and current versions per key; ``is_valid`` allows one current at most."""
    return (
        dimension.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("version_count"),
            F.sum(F.col("is_current").cast("bigint")).alias("current_count"),
        )
        .withColumn("is_valid", F.col("current_count") <= 1)
    )


def overlapping_versions(dimension: DataFrame, key: str) -> DataFrame:
    """Intervals held by several versions, or begun before an earlier one has ended.

    Equal intervals collapse first. What is left per key is bounded by the
    number of loads, and each interval is compared with the latest end so far,
    which also finds one that lies inside a long one.
    """
    in_order = Window.partitionBy(key).orderBy("effective_from", "effective_to")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, -1)
    open_end = F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz")
    return (
        dimension.groupBy(key, "effective_from", "effective_to")
        .agg(F.count(F.lit(1)).alias("version_count"))
        .withColumn("ended_by", F.max(F.coalesce("effective_to", open_end)).over(so_far))
        .where("version_count > 1 OR effective_from < ended_by")
    )


def row_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """``layer, table_name, row_count`` for each given table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count"
        )
        for (layer, table), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def state_difference(before: DataFrame, after: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows whose number differs, with ``surplus`` > 0 if ``after`` has more.

    Empty means equal as multisets. One aggregation with partial sums does for
    both directions; ``exceptAll`` would need two.
    """
    columns = [c for c in before.columns if c not in ignore]
    signed = before.select(*columns, F.lit(-1).cast("bigint").alias("surplus")).unionByName(
        after.select(*columns, F.lit(1).cast("bigint").alias("surplus"))
    )
    return (
        signed.groupBy(*columns)
        .agg(F.sum("surplus").alias("surplus"))
        .where("surplus <> 0")
    )
