"""Why rows of Bronze do not arrive in Silver: one row per dropped row, with the first thing that is wrong with it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from siltstone.functions.dates import AsOf
from siltstone.operators.cleanse import Reference, TableSpec, cleaned
from siltstone.operators.dedupe import latest_version

# Reasons that do not come from a rule.
NO_KEY, SUPERSEDED = "key missing", "superseded"
# Names a row of the stored table by its place.
PLACE = "_place"


def _shared(spec: TableSpec) -> str:
    return f"{spec.unique} shared"


def _orphan(reference: Reference) -> str:
    return f"{reference.column} unknown"


def reasons(spec: TableSpec) -> tuple[str, ...]:
    """Everything that may be wrong with a row, in the order of the checks."""
    unique = (_shared(spec),) if spec.unique else ()
    broken = tuple(rule.broken for rule in spec.row_rules)
    return (NO_KEY, SUPERSEDED, *unique, *broken, *map(_orphan, spec.references))


def _spread(rows: DataFrame, column: str) -> Column:
    # NULLs have no partner; a text that no value has serves as well and keeps them apart.
    return F.coalesce(rows[column].cast("string"), F.concat(F.lit("\0"), rows[PLACE].cast("string")))


def judged(
    newest: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame], as_of: AsOf
) -> DataFrame:
    """The cleansed newest versions with ``reason``: the first check each fails, NULL if it passes all.

    What ``accepted`` filters is a flag here, so one pass sees every check of every row. Parents
    are left joins whose match is the flag; a hot value is split by the adaptive skew join.
    """
    checks: list[tuple[str, Column]] = []
    rows = newest
    if spec.unique:
        value = F.col(spec.unique).cast("string").alias("_value")
        shared = rows.where(F.col(spec.unique).isNotNull()).groupBy(value).count().where("count > 1").select("_value")
        rows = rows.join(shared, _spread(rows, spec.unique) == F.col("_value"), "left")
        checks.append((_shared(spec), F.col("_value").isNull()))
    checks += [(rule.broken, F.coalesce(rule(as_of), F.lit(False))) for rule in spec.row_rules]
    for number, reference in enumerate(spec.references):
        known = f"_known{number}"
        keys = parents[reference.parent].select(F.col(reference.key).cast("string").alias(known))
        rows = rows.join(keys, _spread(rows, reference.column) == F.col(known), "left")
        found = F.col(known).isNotNull()
        checks.append((_orphan(reference), F.col(reference.column).isNull() | found if reference.optional else found))
    failed = [F.when(~passes, F.lit(name)) for name, passes in checks]
    return rows.select(*newest.columns, F.coalesce(*failed, F.lit(None).cast("string")).alias("reason"))


def reject_reasons(
    bronze: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame], as_of: AsOf
) -> DataFrame:
    """``table_name, row_key, reason`` and the change times of each row that Silver doesn't have.

    ``bronze`` must be a stored table: rows are told apart by their place in its files, which both
    branches read. The newest version of each key is judged by itself; then every row asks
    whether it is one of these, in a join on the place, which no hot key can skew.
    """
    placed = bronze.withColumn(PLACE, F.monotonically_increasing_id())
    newest = cleaned(latest_version(placed, spec.key), spec, PLACE)
    verdicts = judged(newest, spec, parents, as_of).select(
        F.col(PLACE).alias("_judged"), F.coalesce("reason", F.lit("")).alias("_verdict")
    )
    has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in spec.key])
    reason = (
        F.when(~has_key, F.lit(NO_KEY))
        .when(F.col("_judged").isNull(), F.lit(SUPERSEDED))
        .otherwise(F.col("_verdict"))
    )
    times = ("created_at", "updated_at", "load_timestamp")
    key_text = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in spec.key])
    return (
        placed.select(*spec.key, *times, PLACE)
        .join(verdicts, F.col(PLACE) == F.col("_judged"), "left")
        .withColumn("reason", reason)
        .where("reason <> ''")
        .select(F.lit(spec.name).alias("table_name"), key_text.alias("row_key"), "reason", *times)
    )


def counted(rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, Observation]:
    """``rows`` and the number of each reason, known once they have been written."""
    seen = Observation(f"rejects of {spec.name}")
    counts = [F.count_if(F.col("reason") == name).alias(f"n{i}") for i, name in enumerate(reasons(spec))]
    return rows.observe(seen, *counts), seen


def by_reason(seen: Observation, spec: TableSpec) -> dict[str, int]:
    found = {name: seen.get[f"n{i}"] for i, name in enumerate(reasons(spec))}
    return {name: n for name, n in found.items() if n}
