"""Slowly changing dimensions, type 2, as a rebuild."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from siltstone.functions.dates import ntz
from siltstone.functions.keys import version_key

# Fixed value: the end of an open version.
OPEN_END = dt.datetime(9999, 12, 31, 23, 59, 59)

PERIOD_COLUMNS = (
    "effective_from",
    "effective_to",
    "is_current",
    "created_at",
    "updated_at",
    "source_system",
)


@dataclass(frozen=True)
class ScdSpec:
    name: str
    surrogate: str
    key: str
    tracked: tuple[str, ...]
    anchor: dt.datetime

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.surrogate, self.key, *self.tracked, *PERIOD_COLUMNS)


def one_row_per_key(profile: DataFrame, spec: ScdSpec, on_duplicate: str) -> DataFrame:
    """Apply the rule for profile rows that share a business key."""
    if on_duplicate == "keep_all":
        return profile
    if on_duplicate == "latest":
        # Rows without a key are not copies of one another.
        keyed, unkeyed = profile.where(f"{spec.key} IS NOT NULL"), profile.where(f"{spec.key} IS NULL")
        newest = Window.partitionBy(spec.key).orderBy(
            F.col("updated_at").desc_nulls_last(),
            *[F.col(c).asc_nulls_first() for c in (*spec.tracked, "created_at")],
        )
        return (
            keyed.withColumn("_n", F.row_number().over(newest))
            .where("_n = 1")
            .drop("_n")
            .unionByName(unkeyed)
        )
    if on_duplicate == "fail":
        # Checked while the rows pass, so it needs no action of its own.
        columns = profile.columns
        copies = (
            profile.where(f"{spec.key} IS NOT NULL")
            .groupBy(spec.key)
            .agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*columns)).alias("_row"))
        )
        message = F.concat(
            F.lit(f"{spec.name}: more than one source row for "), F.col(spec.key).cast("string")
        )
        checked = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(message))
        return (
            copies.select(checked.alias("_row"))
            .select("_row.*")
            .unionByName(profile.where(f"{spec.key} IS NULL"))
        )
    raise ValueError(f"unknown on_duplicate: {on_duplicate}")


def _newest_states(profile: DataFrame, spec: ScdSpec) -> DataFrame:
    """Per key, the newest state and the newest one that differs from it.

    With these two the newest source row that differs from *any* given version
    is known, so shared business keys need no pairing of source rows with
    versions. Equal states collapse before the shuffle.
    """
    by_state = (
        profile.where(F.col(spec.key).isNotNull())
        .groupBy(spec.key, F.struct(*spec.tracked).alias("state"))
        .agg(F.max("updated_at").alias("at"))
    )
    newest = Window.partitionBy(spec.key).orderBy(F.col("at").desc_nulls_last(), F.col("state"))
    first, second = F.col("_n") == 1, F.col("_n") == 2
    return (
        by_state.withColumn("_n", F.row_number().over(newest))
        .where("_n <= 2")
        .groupBy(F.col(spec.key).alias("_key"))
        .agg(
            F.max(F.when(first, F.col("state"))).alias("_first"),
            F.max(F.when(first, F.col("at"))).alias("_first_at"),
            F.max(F.when(second, F.col("at"))).alias("_second_at"),
            F.max("_n").alias("_states"),
        )
    )


def _compare(versions: DataFrame, states: DataFrame, spec: ScdSpec, how: str) -> DataFrame:
    """Join versions to the newest states and add ``_differs`` and ``_closes_at``."""
    same = F.struct(*spec.tracked).eqNullSafe(F.col("_first"))
    differs_at = F.when(same, F.col("_second_at")).otherwise(F.col("_first_at"))
    current = F.coalesce(F.col("is_current"), F.lit(False))
    return (
        versions.join(states, versions[spec.key] == states["_key"], how)
        .withColumn("_differs", current & F.when(same, F.col("_states") > 1).otherwise(True))
        .withColumn(
            "_closes_at", F.when(current & (differs_at > F.col("effective_from")), differs_at)
        )
    )


def close_changed(dimension: DataFrame, profile: DataFrame, spec: ScdSpec) -> DataFrame:
    """The given versions; a current one with newer, different source data is closed.

    A change whose ``updated_at`` is NULL or not after ``effective_from`` is
    ignored.
    """
    return (
        _compare(dimension, _newest_states(profile, spec), spec, "left")
        .withColumn("effective_to", F.coalesce("_closes_at", "effective_to"))
        .withColumn("updated_at", F.coalesce("_closes_at", "updated_at"))
        .withColumn("is_current", F.col("is_current") & F.col("_closes_at").isNull())
        .select(*spec.columns)
    )


def _with_key_states(profile: DataFrame, versions: DataFrame, spec: ScdSpec) -> DataFrame:
    """Tell each profile row whether its key has versions, a current one, and one that ended when the row changed.

    One aggregation: a load closes a key's versions at two moments at most, so the ends of a key are few.
    """
    known = (
        versions.where(F.col(spec.key).isNotNull())
        .groupBy(F.col(spec.key).alias("_key"))
        .agg(
            F.max("is_current").alias("_has_current"),
            F.collect_set(F.when(~F.col("is_current"), F.col("effective_to"))).alias("_ends"),
        )
    )
    return profile.join(known, profile[spec.key] == F.col("_key"), "left")


_IS_NEW_KEY = "_key IS NULL"
_IS_NEW_VERSION = "_key IS NOT NULL AND NOT coalesce(_has_current, false) AND array_contains(_ends, updated_at)"


def unmatched_ends(profile: DataFrame, versions: DataFrame, spec: ScdSpec) -> DataFrame:
    """One row: the range of ``updated_at`` of profile rows whose key was closed, but not at that moment.

    Only such rows can match a version that ended in an earlier load. There are none unless rows share their key.
    """
    left = _with_key_states(profile, versions, spec).where(
        "_key IS NOT NULL AND NOT coalesce(_has_current, false) AND NOT array_contains(_ends, updated_at)"
    )
    return left.agg(F.min("updated_at").alias("first"), F.max("updated_at").alias("last"))


def scd2_merge(
    dimension: DataFrame, profile: DataFrame, spec: ScdSpec, on_duplicate: str = "keep_all"
) -> DataFrame:
    """The dimension after a load: old versions, closed versions, new versions.

    * A key without any version gets one from the anchor.
    * A known key without a current version, but with one that ended at the
      source's ``updated_at``, gets a new version from there.
    * Keys missing from the profile stay as they are.

    ``on_duplicate`` decides about profile rows that share a key: ``keep_all``
    inserts each of them, ``latest`` keeps the newest, ``fail`` raises.
    """
    profile = one_row_per_key(profile, spec, on_duplicate)
    current, history = split_versions(dimension)
    versions = history.unionByName(close_changed(current, profile, spec))
    return versions.unionByName(new_versions(versions, profile, spec))


def split_versions(dimension: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Current versions, and those that have ended and can never change again."""
    current = F.coalesce(F.col("is_current"), F.lit(False))
    return dimension.where(current), dimension.where(~current)


def new_versions(versions: DataFrame, profile: DataFrame, spec: ScdSpec) -> DataFrame:
    """The rows a load inserts, given the versions that ``close_changed`` left."""
    starts = (
        F.when(F.expr(_IS_NEW_KEY), ntz(spec.anchor))
        .when(F.expr(_IS_NEW_VERSION), F.col("updated_at"))
    )
    return (
        _with_key_states(profile, versions, spec)
        .withColumn("effective_from", starts)
        .where("effective_from IS NOT NULL")
        .withColumn("effective_to", ntz(OPEN_END))
        .withColumn("is_current", F.lit(True))
        .withColumn(
            spec.surrogate,
            version_key(F.col(spec.key), F.col("effective_from"), map(F.col, spec.tracked)),
        )
        .select(*spec.columns)
    )


def scd2_changes(dimension: DataFrame, profile: DataFrame, spec: ScdSpec) -> DataFrame:
    """What the next merge would do, one row per business key of the profile.

    ``new``: first version of the key; ``changed``: a current version will be
    closed; ``stale``: attributes differ, but the source is not newer;
    ``unchanged``: nothing to do.
    """
    # Names for the ranks below, in rising order.
    names = F.array(*map(F.lit, ("new", "unchanged", "stale", "changed")))
    rank = (
        F.when(F.col(spec.key).isNull(), 1)
        .when(F.col("_closes_at").isNotNull(), 4)
        .when(F.col("_differs"), 3)
        .otherwise(2)
    )
    return (
        _compare(dimension, _newest_states(profile, spec), spec, "right")
        .groupBy(F.col("_key").alias("business_key"))
        .agg(F.max(rank).alias("rank"))
        .select("business_key", F.element_at(names, F.col("rank")).alias("change"))
    )
