"""Silver from what has changed: no load reads Bronze again that an earlier one has seen.

Beside each Silver table stands a table of winners: the newest Bronze version of each key as it came, bad ones
included, with a mark whether Silver has it. A load merges the Bronze parts it has not seen yet with the winners of
their keys, and judges again only rows whose verdict may differ from last time:

* winners that have changed;
* winners that Silver doesn't have, since time passes and parents arrive;
* rows that refer to a parent row which has left Silver in this load;
* rows that share a unique value with a winner that has changed.

All other rows keep their verdict, because a moment that has passed stays passed. Where that can't be relied on, all
winners are judged: if the moment of the load lies before that of the last one, or a parent has been loaded without this
table. If a Bronze part that has been seen is gone (a full refresh, a repeated batch), the winners are found anew.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.dates import AsOf
from siltstone.operators.audit import counts
from siltstone.operators.cleanse import LINEAGE, TableSpec, cleaned
from siltstone.operators.dedupe import latest_version
from siltstone.operators.rejects import PLACE, judged
from siltstone.session import Stage
from siltstone.sources.tables import TableStore

# Whether Silver has a winner; the last column of its table.
ACCEPTED = "_accepted"


def _keys(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return rows.select(*[F.col(k).alias(f"_key_{k}") for k in spec.key])


def _same_key(rows: DataFrame, spec: TableSpec) -> Column:
    return reduce(Column.__and__, [rows[k] == F.col(f"_key_{k}") for k in spec.key])


def _matches(rows: DataFrame, column: str, values: DataFrame, flag: str) -> DataFrame:
    """``rows`` with a flag: does the column have one of these (distinct, not NULL) values?"""
    (value,) = values.columns
    named = values.select(F.col(value).alias(f"{flag}_value"))
    joined = rows.join(named, rows[column] == F.col(f"{flag}_value"), "left")
    return joined.withColumn(flag, F.col(f"{flag}_value").isNotNull()).drop(f"{flag}_value")


class TableChange:
    """One table's part of a load."""

    def __init__(self, store: TableStore, spec: TableSpec, as_of: AsOf, stage: Stage, is_parent: bool):
        self.is_parent = is_parent
        self.store, self.spec, self.as_of, self.stage = store, spec, as_of, stage
        self.bronze = store.snapshot(f"bronze.{spec.name}")
        self.before = store.snapshot(f"winners.{spec.name}")
        self.note = self.before.parts[0].get("note") if self.before.parts else None
        if self.note and not (self._still_there() and self._same_columns()):
            self.note = None
        # Keys that have left Silver, once the table is loaded; None if that isn't known.
        self.removed: DataFrame | None = None

    def _still_there(self) -> bool:
        return set(self.note["seen"]) <= {p["dir"] for p in self.bronze.parts}

    def _same_columns(self) -> bool:
        return self.before.columns == [*self.bronze.columns, ACCEPTED]

    def run(self, silver: Mapping[str, DataFrame], parents: Mapping[str, TableChange]) -> dict[str, int]:
        spec = self.spec
        untouched, newest, touched = self._merged()
        again = self._recheck(untouched, touched, parents)
        candidates = newest.unionByName(again.where("_again").drop("_again"))
        # What cleansing changes or leaves out goes along, for the table of winners. Its place tells rows without a parent apart.
        raw = [c for c in candidates.columns if c not in (*spec.columns, *LINEAGE) or c in spec.clean]
        packed = candidates.withColumn("_raw", F.struct(*raw)).withColumn(PLACE, F.monotonically_increasing_id())
        verdicts = judged(cleaned(packed, spec, "_raw", PLACE), spec, silver, self.as_of)
        verdicts = self.stage.keep(f"verdicts_{spec.name}", verdicts.drop(PLACE))
        stay = again.where("NOT _again").drop("_again")

        passed = verdicts.where("reason IS NULL")
        columns = (*spec.columns, *LINEAGE)
        rows = cleaned(stay, spec).select(*columns).unionByName(passed.select(*columns))
        loaded = self.store.replace_unless_empty(f"silver.{spec.name}", rows)
        if self.is_parent and self.note is not None and self.note["loaded"]:
            left = touched.where(ACCEPTED).unionByName(again.where(f"_again AND {ACCEPTED}").drop("_again"))
            gone = _keys(left, spec).join(passed, _same_key(passed, spec), "left_anti").distinct()
            self.removed = self.stage.keep(f"removed_{spec.name}", gone)
        as_it_came = [F.col(f"_raw.{c}" if c in raw else c).alias(c) for c in self.bronze.columns]
        winners = stay.unionByName(verdicts.select(*as_it_came, F.col("reason").isNull().alias(ACCEPTED)))
        note = {
            "seen": [p["dir"] for p in self.bronze.parts],
            "as_of": self.as_of.ts.isoformat(),
            # Without rows Silver keeps its old ones, which no mark tells.
            "loaded": loaded,
            "parents": {p: parents[p].after for p in spec.parents},
        }
        self.store.replace(f"winners.{spec.name}", winners, base=self.before, note=note)
        self.after = self.before.version + 1
        # Nobody else reads winners, and what children need is in a table of its own.
        self.store.forget(self.before)
        self.stage.remove(*[f"{table}_{spec.name}" for table in ("verdicts", "newest", "new")])
        return counts(source=self.bronze.row_count, processed=loaded)

    def _merged(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Winners of keys without new rows, the newest rows of the others, and what the winners of these were."""
        spec, seen = self.spec, set(self.note["seen"]) if self.note else set()
        fresh = self.bronze.rows(lambda part: part["dir"] not in seen).withColumn(ACCEPTED, F.lit(False))
        new = latest_version(fresh, spec.key)
        if self.note is None:
            nothing = fresh.where(F.lit(False))
            # Only a unique column has the rows read twice.
            return nothing, self.stage.keep(f"newest_{spec.name}", new) if spec.unique else new, nothing
        new = self.stage.keep(f"new_{spec.name}", new)
        winners, keys = self.before.rows(), _keys(new, spec)
        touched = winners.join(keys, _same_key(winners, spec), "left_semi")
        untouched = winners.join(keys, _same_key(winners, spec), "left_anti")
        # A mark is no part of a version: it must not decide between equal ones.
        both = touched.withColumn(ACCEPTED, F.lit(False)).unionByName(new)
        return untouched, latest_version(both, spec.key), touched

    def _recheck(self, untouched: DataFrame, touched: DataFrame, parents: Mapping[str, TableChange]) -> DataFrame:
        """The untouched winners with ``_again``: may their verdict differ from last time?"""
        spec = self.spec
        again, rows = ~F.col(ACCEPTED), untouched
        if self.note is None or self._all_again(parents):
            return rows.withColumn("_again", F.lit(True))
        flags = []
        for number, reference in enumerate(spec.references):
            flag = f"_gone{number}"
            rows = _matches(rows, reference.column, parents[reference.parent].removed, flag)
            flags.append(flag)
        if spec.unique:
            # Values as Silver has them: cleansing may make two of them equal.
            value = spec.clean.get(spec.unique, lambda c: c)
            new = self.stage.spark.read.parquet(f"{self.stage.root}/new_{spec.name}")
            values = new.select(value(F.col(spec.unique)).alias("v")).where("v IS NOT NULL").distinct()
            rows = _matches(rows.withColumn("_value", value(F.col(spec.unique))), "_value", values, "_shared")
            flags += ["_shared"]
            rows = rows.drop("_value")
        for flag in flags:
            again = again | F.col(flag)
        return rows.withColumn("_again", again).select(*untouched.columns, "_again")

    def _all_again(self, parents: Mapping[str, TableChange]) -> bool:
        back = self.as_of.ts < dt.datetime.fromisoformat(self.note["as_of"])
        known = self.note["parents"]
        return back or any(parents[p].removed is None or known.get(p) != parents[p].before.version for p in self.spec.parents)
