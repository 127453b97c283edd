"""Relational source and sink through Spark's JDBC data source.

Rows move between the database and the executors only. A partition column
gives one range query per task; without one, Spark reads in a single task, so
that form is meant for small reference tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How to cut a table scan into ``parts`` range queries."""

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.parts),
        }


def read_options(
    url: str, table: str, connection: Mapping[str, str], split: Split | None, fetch_size: int
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
        **connection,
        **(split.options() if split else {}),
    }


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    connection: Mapping[str, str],
    split: Split | None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A source table; filters on it (see ``changed_between``) run in the database.

    To read a table in a single task, ``None`` has to be written out.
    """
    options = read_options(url, table, connection, split, fetch_size)
    return spark.read.format("jdbc").options(**options).load()


def literal(value: object) -> str:
    """A value as SQL text."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"no bound: {value!r}")
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no bound: {value!r}")


def depth_query(table: str, column: str, parts: int) -> str:
    """One row with the values that cut a column into ``parts`` ranges of like content, by the database's percentiles."""
    points = [f"percentile_disc({i / parts:.6g}) WITHIN GROUP (ORDER BY {column}) AS b{i}" for i in range(1, parts)]
    return f"SELECT {', '.join(points)} FROM {table}"


def range_predicates(column: str, bounds: Iterable[object]) -> list[str]:
    """Conditions of which each row fulfils exactly one: ranges between the bounds, and NULL.

    Equal bounds fall together, and the least value of a range belongs to it; so a value that makes up many parts gets a range
    that begins with it.
    """
    cuts = [literal(b) for b in sorted({b for b in bounds if b is not None})]
    if not cuts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]}", *inner, f"{column} >= {cuts[-1]}", f"{column} IS NULL"]


def read_by_content(
    spark: SparkSession,
    url: str,
    table: str,
    connection: Mapping[str, str],
    column: str,
    parts: int,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A source table in tasks of like size whatever the distribution of ``column``: one pass for its percentiles, then a range per task."""
    if parts < 2:
        return read_table(spark, url, table, connection, None, fetch_size)
    options = read_options(url, f"({depth_query(table, column, parts)}) AS depth", connection, None, fetch_size)
    bounds = spark.read.format("jdbc").options(**options).load().first()
    predicates = range_predicates(column, bounds)
    properties = {**connection, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def write_table(
    rows: DataFrame,
    url: str,
    table: str,
    connection: Mapping[str, str],
    mode: str = "append",
    batch_size: int = 10_000,
) -> None:
    """Insert by column name; ``overwrite`` empties the table but keeps its definition."""
    (
        rows.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch_size), truncate="true", **connection)
        .mode(mode)
        .save()
    )
