"""Bronze to Silver: newest version, clean text, row rules, references."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.dates import AsOf
from siltstone.operators.dedupe import latest_version, unique_only
from siltstone.operators.rules import Rule, present

LINEAGE = ("created_at", "updated_at", "load_timestamp", "source_system")


@dataclass(frozen=True)
class Reference:
    """``column`` must exist as the key of ``parent``; NULL passes if optional."""

    column: str
    parent: str
    optional: bool = False
    parent_key: str | None = None

    @property
    def key(self) -> str:
        return self.parent_key or self.column


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    columns: tuple[str, ...]
    clean: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    references: tuple[Reference, ...] = ()
    unique: str | None = None

    @property
    def row_rules(self) -> tuple[Rule, ...]:
        # A value that must be unique must be there.
        unique = (self.unique,) if self.unique and self.unique not in self.required else ()
        return (*map(present, (*self.required, *unique)), *self.rules)

    @property
    def parents(self) -> tuple[str, ...]:
        return tuple(r.parent for r in self.references)


def cleanse(
    bronze: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame], as_of: AsOf
) -> DataFrame:
    """The Silver rows of one table.

    Rules come after deduplication: if the newest version is bad, the key is
    dropped and no older version takes its place. Row rules run before the
    reference joins, so rejected rows are not shuffled for them.
    """
    return accepted(cleaned(latest_version(bronze, spec.key), spec), spec, parents, as_of)


def cleaned(rows: DataFrame, spec: TableSpec, *more: str) -> DataFrame:
    """The table's columns with their texts cleansed, and those named in ``more`` as they are."""
    texts = [spec.clean[c](F.col(c)).alias(c) if c in spec.clean else F.col(c) for c in spec.columns]
    return rows.select(*texts, *LINEAGE, *more)


def accepted(
    rows: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame], as_of: AsOf
) -> DataFrame:
    """Those of the cleansed newest versions that pass all rules."""
    if spec.unique:
        # Compares all newest versions, also those that fail another rule.
        rows = unique_only(rows, spec.unique)
    for rule in spec.row_rules:
        rows = rows.where(rule(as_of))
    for reference in spec.references:
        rows = check_reference(rows, spec.key, reference, parents[reference.parent])
    return rows.select(*spec.columns, *LINEAGE)


def check_reference(
    rows: DataFrame, key: tuple[str, ...], reference: Reference, parent: DataFrame
) -> DataFrame:
    """Keep rows whose reference exists in ``parent``, whose key is unique.

    No broadcast hint: Spark broadcasts a parent it knows, or at run time
    finds, to be below its threshold, and else shuffles. A hot value on the
    left is then split by the adaptive skew join, which both join types allow.
    """
    known = parent.select(F.col(reference.key).alias("_known"))
    if not reference.optional:
        return rows.join(known, rows[reference.column] == known["_known"], "left_semi")
    # NULLs would all hash to one partition. Any other value serves them as
    # well, since NULL passes whether or not the join finds a partner.
    spread = F.coalesce(rows[reference.column], F.xxhash64(*[rows[k] for k in key]))
    return (
        rows.join(known, spread == known["_known"], "left")
        .where(F.col(reference.column).isNull() | F.col("_known").isNotNull())
        .drop("_known")
    )
