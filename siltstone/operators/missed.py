"""Changes that a watermark has passed over.

A delta load takes what is newer than the newest change it holds. A row that is committed late, with a change time at or
below that, is never taken. To find such rows, both sides are reduced to one digest per bucket of keys; only keys of
buckets that differ are compared, so a source that is in step costs one scan of its key and change times and a shuffle of
one small row per bucket and task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.dates import ntz

BUCKETS = 65536


def newest_change() -> Column:
    return F.greatest("created_at", "updated_at")


def _newest(rows: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Per key its newest change and its bucket. Many versions of a key collapse before the shuffle."""
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    newest = rows.where(has_key).groupBy(*key).agg(F.max(newest_change()).alias("changed"))
    return newest.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def bucket_digests(newest: DataFrame, key: Sequence[str]) -> DataFrame:
    """``_bucket, n, total, mixed``: the keys of a bucket with their newest changes, as a set."""
    value = F.xxhash64(*key, F.col("changed").isNull(), "changed")
    return newest.groupBy("_bucket").agg(
        F.count("*").alias("n"), F.sum(value.cast("decimal(38,0)")).alias("total"), F.bit_xor(value).alias("mixed")
    )


def missed_changes(
    source: DataFrame, bronze: DataFrame, key: Sequence[str], until: dt.datetime, buckets: int = BUCKETS
) -> DataFrame:
    """Keys whose newest state in the source (of those up to ``until``) Bronze lacks, with both change times.

    A key that Bronze holds no row of is missed also if it has no change time, which a delta load never takes. Older versions
    that were missed don't count, since nothing reads them; nor does what Bronze alone holds, or
    holds in a newer state, as after a delete in the source. Rows with NULL in the key are left out. Repeated rows
    count once. Change times in Bronze may be later than ``until``.
    """
    change = newest_change()
    ours = _newest(source.where(change.isNull() | (change <= ntz(until))), key, buckets)
    theirs = _newest(bronze, key, buckets)
    left, right = bucket_digests(ours, key).alias("l"), bucket_digests(theirs, key).alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("_bucket", "n", "total", "mixed")]
    # At most as many rows as there are buckets; Spark broadcasts them if they are small.
    differ = left.join(right, reduce(lambda a, b: a & b, same), "left_anti").select("_bucket")
    ours = ours.join(differ, "_bucket", "left_semi")
    theirs = theirs.join(differ, "_bucket", "left_semi").withColumnsRenamed({"changed": "bronze_changed"})
    held = theirs.select(*key, "bronze_changed", F.lit(True).alias("_held"))
    lacks = F.col("_held").isNull() | F.coalesce(F.col("changed") > F.col("bronze_changed"), F.lit(False))
    # A change where Bronze knows of none.
    lacks = lacks | (F.col("changed").isNotNull() & F.col("bronze_changed").isNull())
    found = ours.join(held, list(key), "left").where(lacks)
    return found.select(*key, F.col("changed").alias("source_changed"), "bronze_changed")
