"""Complete loads over a table store: Bronze, Silver, Gold, each with its audit.

Every function runs the steps of one layer in dependency order and returns the
task results that the audit adds up. Counts come from the writes themselves,
and earlier layers are read back from the store, so no step repeats another.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.dates import AsOf, Calendar, ntz
from siltstone.operators.audit import (
    close_runs,
    counts,
    open_runs,
    roll_up,
    run_record,
    task_results,
)
from siltstone.operators.calendar import dim_date, spanning, spine_size
from siltstone.operators.cleanse import cleanse
from siltstone.operators.missed import missed_changes
from siltstone.operators.months import collected, differing, month_digests, within_months
from siltstone.operators.rejects import by_reason, counted, reject_reasons
from siltstone.operators.scd2 import (
    ScdSpec,
    close_changed,
    new_versions,
    one_row_per_key,
    split_versions,
    unmatched_ends,
)
from siltstone.plans.changes import TableChange
from siltstone.plans.dimensions import DIMENSIONS, empty_dimension
from siltstone.plans.facts import FACTS, DenseFact
from siltstone.plans.profiles import PROFILES
from siltstone.plans.silver import SPECS
from siltstone.sources.extract import EPOCH, delta_extract, full_extract
from siltstone.session import Stage
from siltstone.sources.tables import ConcurrentWrite, Snapshot, TableStore

AUDIT_TABLE = "audit.etl_audit"
# The batches of a dimension's table.
CURRENT, ENDED, DORMANT = "current", "ended", "dormant"
Results = dict[str, object]

# Tables loaded side by side unless a caller says otherwise.
PARALLEL = 4


class PartlyFailed(Exception):
    """Some tables could not be loaded; ``results`` has those that were."""

    def __init__(self, results: Results, errors: Mapping[str, BaseException]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in errors.items()))
        self.results, self.errors = dict(results), dict(errors)


def _try_each(
    names: Iterable[str], load: Callable[[str], object], parallel: int
) -> tuple[Results, dict[str, BaseException]]:
    """Load tables that do not depend on one another, some at a time.

    One small table cannot fill a cluster; Spark runs the jobs of several
    driver threads side by side. A table that fails doesn't hide the others.
    """
    names = list(names)
    with ThreadPoolExecutor(parallel) as pool:
        waiting = {name: pool.submit(load, name) for name in names}
    errors = {name: f.exception() for name, f in waiting.items() if f.exception()}
    return {name: f.result() for name, f in waiting.items() if name not in errors}, errors


def each(names: Iterable[str], load: Callable[[str], object], parallel: int = PARALLEL) -> Results:
    """Load tables side by side; ``PartlyFailed`` if one of them fails."""
    results, errors = _try_each(names, load, parallel)
    if errors:
        raise PartlyFailed(results, errors) from next(iter(errors.values()))
    return results


def silver_waves() -> list[list[str]]:
    """Silver tables in groups; each refers to earlier groups only."""
    waves: list[list[str]] = []
    done: set[str] = set()
    while len(done) < len(SPECS):
        wave = [n for n, s in SPECS.items() if n not in done and done.issuperset(s.parents)]
        waves.append(wave)
        done.update(wave)
    return waves


class Layer(Mapping[str, DataFrame]):
    """Tables of one layer of a store, read on access."""

    def __init__(self, store: TableStore, prefix: str, names: tuple[str, ...]):
        self._store, self._prefix, self._names = store, prefix, names

    def __getitem__(self, name: str) -> DataFrame:
        return self._store.read(f"{self._prefix}.{name}")

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def silver_layer(store: TableStore) -> Layer:
    return Layer(store, "silver", (*SPECS, *PROFILES))


def load_bronze_full(
    store: TableStore,
    sources: Mapping[str, DataFrame],
    as_of: AsOf,
    source_system: str,
    parallel: int = PARALLEL,
) -> Results:
    """Replace each Bronze table by its source; an empty source changes nothing."""

    def load(name: str) -> int:
        rows = full_extract(sources[name], as_of, source_system)
        return store.replace_unless_empty(f"bronze.{name}", rows)

    return each(sources, load, parallel)


def load_bronze_delta(
    store: TableStore,
    sources: Mapping[str, DataFrame],
    until: dt.datetime,
    as_of: AsOf,
    source_system: str,
    batch: str | None = None,
    parallel: int = PARALLEL,
) -> Results:
    """Append what changed since each table's watermark, up to and including ``until``.

    The watermark comes from the manifest, not from the table. A repeated batch
    begins where it began before, so it holds at least what it replaces. A table
    without rows, or without a full load so far, takes everything.
    """

    def start(table: str) -> dt.datetime:
        if not store.exists(table):
            return EPOCH
        begun = store.batch_start(table, batch) if batch else None
        return begun or store.watermark(table) or EPOCH

    def load(name: str) -> int:
        table = f"bronze.{name}"
        after = start(table)
        rows = delta_extract(sources[name], after, until, as_of, source_system)
        return store.append(table, rows, batch, after=after)

    return each(sources, load, parallel)


def _load_silver(
    store: TableStore, as_of: AsOf, load: Callable[[str, Layer], dict[str, int]], parallel: int
) -> Results:
    """Parents first, then the profiles. What refers to a table that failed is not built on its old content but skipped."""
    silver = silver_layer(store)

    def load_profile(name: str) -> dict[str, int]:
        rows = PROFILES[name](silver, as_of)
        return counts(source=0, processed=store.replace_unless_empty(f"silver.{name}", rows))

    results: Results = {}
    errors: dict[str, BaseException] = {}
    for wave in silver_waves():
        ready = [n for n in wave if not errors.keys() & set(SPECS[n].parents)]
        for name in set(wave) - set(ready):
            errors[name] = RuntimeError("skipped: a table it refers to has failed")
        done, failed = _try_each(ready, lambda name: load(name, silver), parallel)
        results, errors = results | done, errors | failed
    if errors:
        raise PartlyFailed(results, errors)
    done, errors = _try_each(PROFILES, load_profile, parallel)
    if errors:
        raise PartlyFailed(results | done, errors)
    return results | done


def load_silver(store: TableStore, as_of: AsOf, parallel: int = PARALLEL) -> Results:
    """Rebuild Silver from all of Bronze."""

    def load(name: str, silver: Layer) -> dict[str, int]:
        bronze = store.snapshot(f"bronze.{name}")
        rows = cleanse(bronze.rows(), SPECS[name], silver, as_of)
        return counts(source=bronze.row_count, processed=store.replace_unless_empty(f"silver.{name}", rows))

    return _load_silver(store, as_of, load, parallel)


def load_silver_changes(store: TableStore, as_of: AsOf, parallel: int = PARALLEL) -> Results:
    """The same Silver, from the Bronze parts that no earlier call has seen; the first call sees all."""
    changes: dict[str, TableChange] = {}
    parents = {p for spec in SPECS.values() for p in spec.parents}
    with Stage(store.spark, f"{store.root}/_stage", compact=True) as stage:

        def load(name: str, silver: Layer) -> dict[str, int]:
            change = TableChange(store, SPECS[name], as_of, stage, name in parents)
            done = change.run(silver, changes)
            changes[name] = change
            return done

        return _load_silver(store, as_of, load, parallel)


def load_rejects(store: TableStore, as_of: AsOf, parallel: int = PARALLEL) -> dict[str, dict[str, int]]:
    """Write the rows that Silver has dropped, with their reasons; gives the number of each reason per table.

    To be run after ``load_silver`` with the same moment. A table's numbers add up to its Bronze rows
    less its Silver rows; they are counted while the rows are written.
    """
    silver = silver_layer(store)

    def load(name: str) -> dict[str, int]:
        spec = SPECS[name]
        found, seen = counted(reject_reasons(store.read(f"bronze.{name}"), spec, silver, as_of), spec)
        store.replace(f"rejects.{name}", found)
        return by_reason(seen, spec)

    return each(SPECS, load, parallel)


def _foreign(snapshot: Snapshot, spec: ScdSpec) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Versions in parts that no load has written: current ones, ended ones, and ended ones of keys without a current one."""
    parts = [p for p in snapshot.parts if p["batch"] not in (CURRENT, ENDED, DORMANT)]
    if not parts:
        return None
    open_, past = split_versions(snapshot.rows(lambda p: p in parts))
    keys = open_.unionByName(snapshot.batch(CURRENT)).select(F.col(spec.key).alias("_key"))
    same = past[spec.key] == F.col("_key")
    return open_, past.join(keys, same, "left_semi"), past.join(keys, same, "left_anti")


def merge_profile(store: TableStore, table: str, profile: DataFrame, spec: ScdSpec, shared: int) -> dict[str, int]:
    """One merge into a stored dimension; ``ConcurrentWrite`` if somebody else has committed to it meanwhile.

    Reads the current versions, and of the ended ones none, in general. A load that closes a key gives it a new version,
    so an ended version belongs to a key with a current one, whose key is thereby known; what a full refresh may have left
    beside them (keys with ended versions only) has a batch of its own. Profile rows that share their key (``shared``
    keys do) can refer to an end of an earlier load; the parts whose ends reach that far are read for them.
    """
    base = store.snapshot(table)
    labels = {"still": CURRENT, "inserted": CURRENT, "closed": ENDED, "moved": ENDED, "dormant": DORMANT}
    if base.version:
        current, known = base.batch(CURRENT), base.batch(DORMANT)
    else:
        current = known = empty_dimension(profile, spec)
    moved = _foreign(base, spec) if base.version else None
    more: list[DataFrame] = []
    if moved:
        open_, past, dormant = moved
        current, known = current.unionByName(open_), known.unionByName(dormant)
        more = [past.withColumn("_label", F.lit("moved")), dormant.withColumn("_label", F.lit("dormant"))]
    with Stage(store.spark, f"{store.root}/_stage") as stage:
        compared = stage.keep(spec.name, close_changed(current, profile, spec))
        versions = compared.unionByName(known)
        if shared:
            first, last = unmatched_ends(profile, versions, spec).first()
            if first is not None:
                versions = versions.unionByName(_ended_between(base, first, last))
                versions = versions.unionByName(moved[1]) if moved else versions
        label = F.when(F.coalesce(F.col("is_current"), F.lit(False)), F.lit("still")).otherwise(F.lit("closed"))
        parts = [compared.withColumn("_label", label)]
        parts.append(new_versions(versions, profile, spec).withColumn("_label", F.lit("inserted")))
        rows = reduce(DataFrame.unionByName, parts + more)
        return store.revise(base, lambda p: p["batch"] in (ENDED, DORMANT), rows, labels, spans=("effective_to",))


def _ended_between(base: Snapshot, first: dt.datetime, last: dt.datetime) -> DataFrame:
    """Versions that ended in a range of time; parts that hold no such end are not read."""

    def reaches(part: dict) -> bool:
        low, high = (part.get("spans") or {}).get("effective_to") or (None, None)
        unknown = low is None or high is None
        return part["batch"] == ENDED and (
            unknown or dt.datetime.fromisoformat(low) <= last and dt.datetime.fromisoformat(high) >= first
        )

    return base.rows(reaches).where(F.col("effective_to").between(ntz(first), ntz(last)))


def load_dimensions(
    store: TableStore, on_duplicate: str = "keep_all", parallel: int = PARALLEL, attempts: int = 5
) -> Results:
    """Merge each profile into its dimension.

    Only current versions are compared with the profile, once; ended ones stay in
    the files they are in. A merge that another one has overtaken is computed again from what that has left, up to
    ``attempts`` times. As in the audit's definition, a merge reports the
    profile's rows and no inserts; the real numbers of new and closed versions
    come along under names of their own, as does the number of business keys
    that several profile rows share.
    """

    def load(name: str) -> dict[str, int]:
        spec, source = DIMENSIONS[name]
        silver = store.snapshot(f"silver.{source}")
        profile = one_row_per_key(silver.rows(), spec, on_duplicate)
        shared = 0
        if on_duplicate == "keep_all":
            keyed = profile.where(F.col(spec.key).isNotNull())
            shared = keyed.groupBy(spec.key).count().where("count > 1").count()
        for attempt in range(attempts):
            try:
                done = merge_profile(store, f"gold.{name}", profile, spec, shared)
                break
            except ConcurrentWrite:
                if attempt + 1 == attempts:
                    raise
        extra = {"new_versions": done["inserted"], "closed_versions": done["closed"], "shared_keys": shared}
        return counts(source=silver.row_count, processed=silver.row_count, inserted=0) | extra

    return each(DIMENSIONS, load, parallel)


def load_facts(
    store: TableStore, as_of: AsOf, calendar: Calendar | None = None, parallel: int = PARALLEL
) -> Results:
    """Rebuild the calendar and the facts; expected rows come from the spine bounds.

    Without a given calendar it reaches from the first period of any spine to ``as_of``.
    """
    silver = silver_layer(store)
    if calendar is None:
        calendar = spanning(as_of, *[bounds(silver, as_of) for _, _, bounds, _ in FACTS.values()])
    store.replace("gold.dim_date", dim_date(store.spark, calendar))

    def load(name: str) -> dict[str, int]:
        fact, dimension, bounds, step = FACTS[name]
        expected = spine_size(bounds(silver, as_of, calendar), step).first()[0]
        rows = fact(silver, store.read(f"gold.{dimension}"), as_of, calendar, cluster=True)
        return counts(source=expected, processed=store.replace(f"gold.{name}", rows))

    return each(FACTS, load, parallel)


def load_fact_months(
    store: TableStore, as_of: AsOf, calendar: Calendar | None = None, parallel: int = PARALLEL
) -> Results:
    """The same facts, but only months whose rows differ are expanded and written; the files of the others stay.

    Each month's part carries the digest of the stretches it was made from. Sums and version spans are computed as
    for a rebuild, since they are as few as there is activity; the dense rows, by far the most, are made for differing months
    only. A table that ``load_facts`` has written carries no digests and is replaced whole, which is also the way
    to go after a change of a fact's definition.
    """
    silver = silver_layer(store)
    if calendar is None:
        calendar = spanning(as_of, *[bounds(silver, as_of) for _, _, bounds, _ in FACTS.values()])
    store.replace("gold.dim_date", dim_date(store.spark, calendar))

    def load(name: str) -> dict[str, int]:
        fact, dimension, bounds, step = FACTS[name]
        expected = spine_size(bounds(silver, as_of, calendar), step).first()[0]
        base = store.snapshot(f"gold.{name}")
        before = {int(p["batch"]): tuple(p["note"]["digest"]) for p in base.parts if p["batch"]}
        with Stage(store.spark, f"{store.root}/_stage") as stage:
            found: dict[int, tuple[str, str]] = {}
            wanted: list[int] = []

            def choose(dense: DenseFact, met: DataFrame) -> DataFrame:
                kept = stage.keep(name, met)
                found.update(collected(month_digests(kept, (dense.surrogate, *dense.carried), dense.measures)))
                wanted.extend(differing(found, before))
                return within_months(kept, wanted)

            rows = fact(silver, store.read(f"gold.{dimension}"), as_of, calendar, cluster=True, choose=choose)
            gone, written = before.keys() - found.keys(), 0
            untagged = any(not p["batch"] for p in base.parts)
            if wanted or gone or untagged or not base.version:
                labelled = rows.withColumn("_label", F.floor(F.col("date_key") / 100).cast("int"))
                notes = {m: {"digest": found[m]} for m in wanted}
                written = store.replace_batches(base, labelled, notes, sorted(gone))
        more = {"written_months": len(wanted), "written_rows": written}
        return counts(source=expected, processed=store.row_count(f"gold.{name}")) | more

    return each(FACTS, load, parallel)


def load_missed(
    store: TableStore,
    sources: Mapping[str, DataFrame],
    until: dt.datetime,
    as_of: AsOf,
    source_system: str,
    parallel: int = PARALLEL,
) -> Results:
    """Append the rows that a watermark has passed over: committed late, with change times at or below it.

    To be run now and then after a delta load with the same ``until``. A second call finds nothing.
    """

    def load(name: str) -> int:
        table, key = f"bronze.{name}", SPECS[name].key
        missed = missed_changes(sources[name], store.read(table), key, until).select(*key)
        changed = F.greatest("created_at", "updated_at")
        known = sources[name].where(changed.isNull() | (changed <= ntz(until)))
        return store.append(table, full_extract(known.join(missed, list(key), "left_semi"), as_of, source_system))

    return each(sources, load, parallel)


def audited(
    store: TableStore,
    run: tuple[str, str, str],
    start: dt.datetime,
    end: Callable[[], dt.datetime],
    tasks: tuple[str, ...],
    load: Callable[[], Results],
) -> Results:
    """Run ``load`` between opening and closing its audit record.

    A task without a result, or a load that raises, leaves the record Failed, with
    the counts of those that did report. A run is one batch of the audit table: closing
    replaces its own record and touches no other, and so does repeating it.
    """
    results: Results = dict.fromkeys(tasks)
    opened, batch = open_runs(run_record(store.spark, *run, start)), json.dumps(run)
    store.append(AUDIT_TABLE, opened, batch)
    try:
        results.update(load())
    except PartlyFailed as failure:
        results.update(dict.fromkeys(failure.errors) | failure.results)
        raise
    finally:
        totals = roll_up(task_results(store.spark, run, results))
        store.append(AUDIT_TABLE, close_runs(opened, totals, end()), batch)
    return results
