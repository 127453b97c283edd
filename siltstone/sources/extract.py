"""Full and watermark-driven extraction from source tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.dates import AsOf, ntz

# Fixed value: the watermark of an empty target.
EPOCH = dt.datetime(1900, 1, 1)


def _with_lineage(source: DataFrame, as_of: AsOf, source_system: str) -> DataFrame:
    return source.withColumns(
        {"load_timestamp": as_of.timestamp, "source_system": F.lit(source_system)}
    )


def full_extract(source: DataFrame, as_of: AsOf, source_system: str) -> DataFrame:
    """Every source row plus lineage. There is no upper bound on change times."""
    return _with_lineage(source, as_of, source_system)


def watermark(target: DataFrame) -> DataFrame:
    """One row: the newest change time the target already holds."""
    newest = F.greatest(F.max("created_at"), F.max("updated_at"))
    return target.agg(F.coalesce(newest, ntz(EPOCH)).alias("last_watermark"))


def last_watermark(target: DataFrame) -> dt.datetime:
    """The watermark as a scalar; the only value of a delta load the driver sees."""
    return watermark(target).first()[0]


def changed_between(after: dt.datetime, until: dt.datetime) -> Column:
    """``after < greatest(created_at, updated_at) <= until``, in pushable form.

    A filter over ``greatest(...)`` never reaches the scan. These three
    conjuncts compare plain columns with literals, so Parquet row groups and
    JDBC sources can skip data. With NULLs the meaning is the same: NULL
    change times are ignored, and a row with neither is never extracted.
    """
    created, updated = F.col("created_at"), F.col("updated_at")
    low, high = ntz(after), ntz(until)
    return (
        ((created > low) | (updated > low))
        & (created.isNull() | (created <= high))
        & (updated.isNull() | (updated <= high))
    )


def delta_extract(
    source: DataFrame, after: dt.datetime, until: dt.datetime, as_of: AsOf, source_system: str
) -> DataFrame:
    """Rows changed in ``(after, until]``; consecutive windows never overlap."""
    return _with_lineage(source.where(changed_between(after, until)), as_of, source_system)
