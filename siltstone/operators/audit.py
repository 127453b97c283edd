"""Run records: open, roll up task results, close, report.

Everything is a DataFrame over ``(batch_id, dag_id, run_id)``, so one call
serves a single run or the history of many.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from siltstone.functions.dates import ntz
from siltstone.functions.keys import surrogate_key

RUN = ("batch_id", "dag_id", "run_id")
COUNTS = (
    "source_record_count",
    "processed_record_count",
    "inserted_record_count",
    "updated_record_count",
    "rejected_record_count",
)
AUDIT_COLUMNS = ("audit_id", *RUN, "start_time", "end_time", "status", *COUNTS)

# Run states.
RUNNING, SUCCESS, FAILED = "Running", "Success", "Failed"

TASK_SCHEMA = (
    "batch_id string, dag_id string, run_id string, task_id string, loaded_rows bigint, "
    + ", ".join(f"{c} bigint" for c in COUNTS)
)


def run_record(spark: SparkSession, batch_id: str, dag_id: str, run_id: str, start: dt.datetime):
    """The identity of one run as a single row, for ``open_runs``."""
    identity = [F.lit(v).alias(n) for n, v in zip(RUN, (batch_id, dag_id, run_id))]
    return spark.range(1).select(*identity, ntz(start).alias("start_time"))


def open_runs(runs: DataFrame) -> DataFrame:
    """Audit rows in state Running, without counts yet."""
    return runs.select(
        surrogate_key(*[F.col(c) for c in RUN]).alias("audit_id"),
        *RUN,
        "start_time",
        F.lit(None).cast("timestamp_ntz").alias("end_time"),
        F.lit(RUNNING).alias("status"),
        *[F.lit(None).cast("bigint").alias(c) for c in COUNTS],
    )


def task_results(spark: SparkSession, run: tuple[str, str, str], results: Mapping[str, object]):
    """Results of one run's tasks as rows: a count, a mapping of counts, or None.

    Any other result counts as missing. One row per task, so the driver holds
    a handful of numbers.
    """
    rows = []
    for task, result in results.items():
        is_count = isinstance(result, int) and not isinstance(result, bool)
        counts = [result.get(c, 0) for c in COUNTS] if isinstance(result, Mapping) else [None] * 5
        rows.append((*run, task, result if is_count else None, *counts))
    return spark.createDataFrame(rows, TASK_SCHEMA)


def roll_up(tasks: DataFrame) -> DataFrame:
    """Totals and state per run.

    A plain count stands for source, processed and inserted rows alike. A task
    that reported nothing fails the run and adds nothing.
    """
    plain, missing = F.col("loaded_rows"), F.lit(True)
    for c in ("loaded_rows", *COUNTS):
        missing = missing & F.col(c).isNull()
    totals = {
        c: F.coalesce(F.col(c), plain if i < 3 else F.lit(None), F.lit(0))
        for i, c in enumerate(COUNTS)
    }
    return tasks.groupBy(*RUN).agg(
        F.when(F.max(missing), FAILED).otherwise(SUCCESS).alias("status"),
        *[F.sum(t).cast("bigint").alias(c) for c, t in totals.items()],
    )


def close_runs(audit: DataFrame, totals: DataFrame, end: dt.datetime) -> DataFrame:
    """The audit table with the records of ``totals`` closed; others are unchanged."""
    closing = totals.select(
        *RUN,
        ntz(end).alias("_end_time"),
        *[F.col(c).alias(f"_{c}") for c in ("status", *COUNTS)],
    )
    changed = ("end_time", "status", *COUNTS)
    kept = [c for c in AUDIT_COLUMNS if c not in changed]
    closes = F.col("_end_time").isNotNull()
    return (
        audit.join(closing, list(RUN), "left")
        .select(*kept, *[F.when(closes, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in changed])
        .select(*AUDIT_COLUMNS)
    )


def latest_runs(audit: DataFrame, count: int = 5) -> DataFrame:
    """The newest runs of each pipeline; planned as a group limit around the shuffle."""
    newest = Window.partitionBy("dag_id").orderBy(
        F.col("start_time").desc(), F.col("batch_id").desc(), F.col("run_id").desc()
    )
    return audit.withColumn("run_rank", F.row_number().over(newest)).where(
        F.col("run_rank") <= count
    )


def load_metrics(table: str, source: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row of counts for a refresh of ``table`` from the rows of ``source``.

    Rejected rows are those that did not arrive, superseded versions included.
    """
    return load_metrics_of(table, source.agg(F.count(F.lit(1)).alias("n")), loaded)


def load_metrics_of(table: str, expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """The same with the number of source rows given as a single-row DataFrame."""
    label, zero = F.lit(table).alias("table_name"), F.lit(0).cast("bigint")
    (number,) = expected.columns
    source_side = expected.select(
        label, F.col(number).alias("source_record_count"), zero.alias("processed_record_count")
    )
    loaded_side = loaded.agg(F.count(F.lit(1)).alias("n")).select(
        label, zero.alias("source_record_count"), F.col("n").alias("processed_record_count")
    )
    # Added up instead of joined: two rows, no pairing.
    return (
        source_side.unionByName(loaded_side)
        .groupBy("table_name")
        .agg(*[F.sum(c).alias(c) for c in COUNTS[:2]])
        .select("table_name", *_counts())
    )


def _counts() -> list:
    source, processed = F.col("source_record_count"), F.col("processed_record_count")
    return [
        source,
        processed,
        processed.alias("inserted_record_count"),
        F.lit(0).cast("bigint").alias("updated_record_count"),
        F.greatest(source - processed, F.lit(0)).cast("bigint").alias("rejected_record_count"),
    ]


def counts(
    source: int, processed: int, inserted: int | None = None, updated: int = 0
) -> dict[str, int]:
    """The same numbers for counts that a write has already reported."""
    values = (
        source,
        processed,
        processed if inserted is None else inserted,
        updated,
        max(source - processed, 0),
    )
    return dict(zip(COUNTS, values))
