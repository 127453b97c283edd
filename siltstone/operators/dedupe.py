"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_CHANGE_COLUMNS = ("updated_at", "created_at", "load_timestamp")


def latest_version(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keep the newest row of each key; rows with a NULL key part are dropped.

    ``row_number() = 1`` plans as a group limit before and after the shuffle,
    so a key with very many versions sends one row per map task. Rows equal in
    all change columns are ordered by their remaining columns, which makes the
    choice repeatable.
    """
    rest = [c for c in rows.columns if c not in (*key, *_CHANGE_COLUMNS)]
    newest_first = Window.partitionBy(*key).orderBy(
        F.col("updated_at").desc_nulls_last(),
        F.col("created_at").desc_nulls_last(),
        F.col("load_timestamp").desc_nulls_first(),
        *[F.col(c).asc_nulls_first() for c in rest],
    )
    has_key = F.lit(True)
    for part in key:
        has_key = has_key & F.col(part).isNotNull()
    return (
        rows.where(has_key)
        .withColumn("_version", F.row_number().over(newest_first))
        .where("_version = 1")
        .drop("_version")
    )


def unique_only(rows: DataFrame, column: str) -> DataFrame:
    """Drop every row whose non-NULL value in ``column`` occurs more than once.

    One aggregation counts and carries the row, so all copies of a repeated
    value collapse before the shuffle and no window holds a whole group.
    """
    counted = rows.groupBy(column).agg(
        F.count(F.lit(1)).alias("_copies"), F.any_value(F.struct(*rows.columns)).alias("_row")
    )
    return counted.where((F.col("_copies") == 1) & F.col(column).isNotNull()).select("_row.*")
