"""Session settings the loads are designed for, and where to cut lineage."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# What a cluster session should have; most are Spark's defaults, named here
# because the plans rely on them.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Saves the Python stack walk behind each expression; plans build twice as fast.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``, which all executors must reach.

    A session that names none gets one beside its tables, if the warehouse is shared as well: on a cluster, the
    default warehouse is a folder of one machine, which is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    return f"{warehouse}/_stage"


# Seconds of a write after which the shuffle files behind it are worth a collection.
LONG_WRITE = 2.0


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Around a write. Spark deletes a job's shuffle files when the driver's JVM has collected its plan, which may be
    long after all others of a load have added theirs; so after a long write it is asked to."""
    began = time.monotonic()
    yield
    if time.monotonic() - began > LONG_WRITE:
        free(spark)


def free(spark: SparkSession) -> None:
    spark._jvm.System.gc()


class Stage:
    """Intermediate tables written once and read by several plans.

    A written table ends the lineage: whatever reads it does not repeat the
    work behind it, also after an executor is lost. Its owner calls ``remove`` (or
    uses it in a ``with`` block) when nothing reads the tables any more. With ``compact`` the disk counts more than
    the time: tables are packed more tightly, and shuffle files freed after long writes.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, compact: bool = False):
        self.spark, self.compact = spark, compact
        folder = folder or shared_folder(spark)
        self.root = f"{folder.rstrip('/')}/stage-{uuid.uuid4().hex}"

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *error: object) -> None:
        self.remove()

    def remove(self, *names: str) -> None:
        """Delete all tables, or those named."""
        for folder in [f"{self.root}/{name}" for name in names] or [self.root]:
            self._delete(folder)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, name: str, rows: DataFrame) -> DataFrame:
        if self.compact:
            with freeing_shuffles(self.spark):
                rows.write.option("compression", "zstd").parquet(f"{self.root}/{name}")
        else:
            rows.write.parquet(f"{self.root}/{name}")
        return self.read(rows.schema, name)

    def read(self, schema: StructType, *names: str) -> DataFrame:
        """Kept tables of one schema, as one."""
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{name}" for name in names])
