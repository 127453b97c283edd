"""Sharding by rendezvous hashing.

Every shard draws a score for a record from the record's key; the highest score wins. A new shard takes
only the records on which it wins, so all others stay where they are. Weights turn a uniform draw u into
``-weight / ln(u)``, which gives each shard its share of records. Only expressions over the key: no shuffle, no state.

A null key is a key like any other; equal keys go to the same shard; ties of scores go to the higher shard
number. The number of a record within its shard (``slot``) is found without gathering a shard or a key in one task: records are dealt
into buckets of a shard, numbered there, and moved by the sizes of the buckets before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per shard for the numbering.
BUCKETS = 512
# Numbers that one row of the plan expands into at once.
STRETCH = 65536


def score(key: Column, shard: int, weight: float) -> Column:
    draw = F.xxhash64(key, F.lit(shard).cast("bigint"))
    u = (F.shiftrightunsigned(draw, 11).cast("double") + 0.5) / float(1 << 53)
    return F.lit(float(weight)) / -F.log(u)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a record among ``len(weights)`` shards. A weight of 0 or less closes a shard."""
    open_shards = [(k, w) for k, w in enumerate(weights) if w > 0]
    if not open_shards:
        raise ValueError("no shard has a positive weight")
    draws = [F.struct(score(key, k, w).alias("score"), F.lit(k).alias("shard")) for k, w in open_shards]
    return F.array_max(F.array(*draws))["shard"]


def crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def with_slots(rows: DataFrame, order: Sequence[str], shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in tasks of a bucket each.

    ``order`` are columns of ``rows`` that deal rows into buckets and order them there. Rows equal in all columns
    are interchangeable: they are counted before they are shuffled, numbered as one and expanded in stretches of ``STRETCH`` that
    are spread over tasks, so neither a repeated key nor a repeated row makes a task large. Rows that differ may share a key:
    all of ``order`` takes part in the dealing. ``rows`` must not have columns named ``slot`` or beginning with ``_``.
    """
    distinct = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in order], F.lit("slot")), F.lit(BUCKETS)).cast("int")
    dealt = distinct.withColumn("_bucket", bucket)
    sizes = dealt.groupBy(F.col(shard).alias("_shard"), F.col("_bucket").alias("_b")).agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_shard", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rest = [c for c in rows.columns if c not in order]
    within = Window.partitionBy(shard, "_bucket").orderBy(*order, *rest)
    earlier = F.coalesce(F.sum("_n").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = dealt.withColumn("_row", earlier)
    # At most shards * BUCKETS rows; no hint, so Spark broadcasts them only if they are small.
    joined = numbered.join(starts, (F.col(shard) == F.col("_shard")) & (F.col("_bucket") == F.col("_b")))
    first, last = F.col("_start") + F.col("_row"), F.col("_start") + F.col("_row") + F.col("_n") - 1
    cut = joined.select(*rows.columns, last.alias("_last"), F.explode(F.sequence(first, last, F.lit(STRETCH))).alias("_from"))
    cut = cut.repartition(F.col(shard), F.floor(F.col("_from") / STRETCH))
    upto = F.least(F.col("_from") + STRETCH - 1, "_last")
    return cut.select(*rows.columns, F.explode(F.sequence("_from", upto)).alias(slot))


def assign(
    docs: DataFrame, weights: Sequence[float], grown: Sequence[float], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per record: key, size, text_crc32, shard, slot, and the shard under the ``grown`` weights."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8
    rows = docs.select(
        F.col(key).alias("_key"),
        size.alias("size"),
        crc32(F.col(text)).alias("text_crc32"),
        shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
    )
    rows = rows.withColumnRenamed("_key", key)
    return with_slots(rows, [key, "text_crc32", "size"])


def write_shards(
    docs: DataFrame,
    path: str,
    weights: Sequence[float],
    key: str = "doc_id",
    files: int = 16,
    column: str = "shard",
) -> None:
    """The records themselves, a folder per shard and up to ``files`` files in each, so no task writes a whole shard.

    Folders are named by ``column``, which must not be one of ``docs``. Rows that share a key are spread unless they are equal.
    """
    if column in docs.columns:
        raise ValueError(f"the records have a column {column}; name the folders otherwise")
    rows = docs.withColumn(column, shard_of(F.col(key), weights))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in docs.columns], F.lit("file")), F.lit(files))
    rows.repartition(F.col(column), spread).write.partitionBy(column).parquet(path)
