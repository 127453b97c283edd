"""What the operators of this folder share."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siltstone.session import Stage, shared_folder

# Rows that Spark hands to Python at once; long texts make batches of few rows.
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Bound an Arrow batch by bytes, so that memory doesn't depend on the length of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def struct(**fields: T.DataType) -> T.StructType:
    """A type that can be named before a session exists, as on workers."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def strings(array: pa.Array) -> list[str]:
    """The texts of a column; null counts as empty."""
    return [x or "" for x in array.to_pylist()]


def written(rows: DataFrame, what: str) -> DataFrame:
    """``rows`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


class Scratch(Stage):
    """Tables that only the steps of one call read. ``remove`` frees their space once the last of them has run."""

    def written(self, rows: DataFrame, what: str) -> DataFrame:
        return self.keep(f"{what}-{uuid.uuid4().hex}", rows)
