"""The registered queries: each takes a session and a folder of the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog.shapes import GIVEN_TABLES, SOURCE_TABLES, shape_sql
from siltstone.functions.dates import AsOf, Calendar
from siltstone.operators import audit, checks
from siltstone.operators.asof import as_of_events, as_of_join
from siltstone.operators.calendar import DAY, MONTH, dim_date, spine, spine_size
from siltstone.operators.cleanse import cleanse
from siltstone.operators.densify import sum_contributions
from siltstone.operators.missed import missed_changes
from siltstone.operators.rejects import reject_reasons
from siltstone.operators.scd2 import scd2_changes, scd2_merge
from siltstone.plans import facts, loads
from siltstone.plans.dimensions import DIMENSIONS, empty_dimension
from siltstone.plans.profiles import PROFILES
from siltstone.plans.silver import SPECS
from siltstone.session import Stage
from siltstone.sources import TableStore, delta_extract, full_extract, last_watermark, watermark

LOADS = {1: AsOf(dt.datetime(2024, 3, 1)), 2: AsOf(dt.datetime(2024, 3, 31))}
NOW = LOADS[2]
# The label that the extracts of the given tables carry.
SOURCE_SYSTEM = "SOURCE_OLTP"
Query = Callable[[SparkSession, str], DataFrame]


class _Tables(Mapping[str, DataFrame]):
    """Silver tables of one load, each written to the shared folder on first use."""

    def __init__(self, warehouse: Warehouse, load: int):
        self._warehouse, self._load, self._kept = warehouse, load, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._kept:
            rows = self._warehouse.silver_rows(name, self._load)
            self._kept[name] = self._warehouse.stage.keep(f"silver{self._load}_{name}", rows)
        return self._kept[name]

    def __iter__(self) -> Iterator[str]:
        return iter(SPECS)

    def __len__(self) -> int:
        return len(SPECS)


class Warehouse:
    """Two loads over the given tables, with what several queries share kept as files.

    Like the pipeline, a query reads the finished tables of the layer before
    it; only its own step is in its plan.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.stage = Stage(spark)
        self._silver = {load: _Tables(self, load) for load in LOADS}
        self._kept: dict[str, DataFrame] = {}
        self._watermarks: dict[str, dt.datetime] = {}

    @cached_property
    def given(self) -> dict[str, DataFrame]:
        return {t: self.spark.read.parquet(f"{self.folder}/{t}.parquet") for t in GIVEN_TABLES}

    def source(self, name: str, load: int = 2) -> DataFrame:
        sql = shape_sql(name, later=load == 2, timestamp_type="TIMESTAMP_NTZ")
        used = {t: df for t, df in self.given.items() if f"{{{t}}}" in sql}
        return self.spark.sql(sql, **used)

    def bronze_full(self, name: str) -> DataFrame:
        return full_extract(self.source(name, 1), LOADS[1], SOURCE_SYSTEM)

    def bronze_delta(self, name: str) -> DataFrame:
        if name not in self._watermarks:
            stored = self._kept.get(f"bronze1_{name}")
            self._watermarks[name] = last_watermark(self.bronze_full(name) if stored is None else stored)
        after = self._watermarks[name]
        return delta_extract(self.source(name, 2), after, NOW.ts, NOW, SOURCE_SYSTEM)

    def bronze(self, name: str, load: int) -> DataFrame:
        full = self.bronze_full(name)
        return full if load == 1 else full.unionByName(self.bronze_delta(name))

    def stored_bronze(self, name: str, load: int = 2) -> DataFrame:
        """Bronze as files: the full extract, computed once for both loads and for the watermark, and the delta beside it."""
        full = self.keep(f"bronze1_{name}", lambda: self.bronze_full(name))
        if load == 1:
            return full
        self.keep(f"bronze_delta_{name}", lambda: self.bronze_delta(name))
        return self.stage.read(full.schema, f"bronze1_{name}", f"bronze_delta_{name}")

    def silver(self, load: int = 2) -> _Tables:
        return self._silver[load]

    def silver_rows(self, name: str, load: int = 2) -> DataFrame:
        return cleanse(self.stored_bronze(name, load), SPECS[name], self.silver(load), LOADS[load])

    def profile_rows(self, name: str, load: int = 2) -> DataFrame:
        return PROFILES[name](self.silver(load), LOADS[load])

    def keep(self, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._kept:
            self._kept[name] = self.stage.keep(name, rows())
        return self._kept[name]

    def profile(self, name: str, load: int = 2) -> DataFrame:
        return self.keep(f"profile{load}_{name}", lambda: self.profile_rows(name, load))

    def dimension_rows(self, name: str, load: int) -> DataFrame:
        spec, source = DIMENSIONS[name]
        profile = self.profile(source, load)
        before = empty_dimension(profile, spec) if load == 1 else self.dimension(name, 1)
        return scd2_merge(before, profile, spec)

    def dimension(self, name: str, load: int = 2) -> DataFrame:
        return self.keep(f"{name}{load}", lambda: self.dimension_rows(name, load))

    def fact_rows(self, name: str, choose: facts.Choice | None = None) -> DataFrame:
        build, dimension, _, _ = facts.FACTS[name]
        return build(self.silver(), self.dimension(dimension), NOW, choose=choose)

    def fact_of_stretches(self, name: str) -> DataFrame:
        """The fact, expanded anew by each reader from kept stretches: its dense rows are not written for it."""
        return self.fact_rows(name, lambda _, met: self.keep(f"stretches_{name}", lambda: met))

    def fact(self, name: str) -> DataFrame:
        return self.keep(name, lambda: self.fact_rows(name))

    def bounds(self, fact: str) -> DataFrame:
        return facts.FACTS[fact][2](self.silver(), NOW)


_warehouses: dict[tuple, Warehouse] = {}


def _files(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the files below ``folder``: other input, other key."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    files = []
    while found.hasNext():
        status = found.next()
        files.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(files))


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, folder, _files(spark, folder))
    if key not in _warehouses:
        _warehouses[key] = Warehouse(spark, folder)
    return _warehouses[key]


def comparable(rows: DataFrame) -> DataFrame:
    """Types that look the same in every engine: dates and timestamps as text, money as double."""

    def column(name: str, kind: str):
        if kind in ("date", "timestamp_ntz"):
            return F.col(name).cast("string").alias(name)
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if name == "average_customer_rating":
            return F.round(name, 6).alias(name)
        return F.col(name)

    return rows.select(*[column(name, kind) for name, kind in rows.dtypes])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- sources and sinks -------------------------------------------------------


def _watermarks(w: Warehouse) -> DataFrame:
    return _union(
        [
            watermark(w.bronze_full(t)).select(F.lit(t).alias("table_name"), "last_watermark")
            for t in SOURCE_TABLES
        ]
    )


def _store(w: Warehouse) -> TableStore:
    return TableStore(w.spark, Stage(w.spark).root)


def _digested(stored: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Table name, key and a digest of each row; digests compare texts of values, so that any engine can make them."""
    parts = []
    for name, (rows, key) in stored.items():
        shown = comparable(rows)
        text: list[Column] = []
        for c in sorted(_plain(rows)):
            # One concatenation: a text for each column, and then one of these, would be copied twice.
            text += [F.lit(f"|{c}=" if text else f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))]
        parts.append(
            shown.select(
                F.lit(name).alias("table_name"),
                F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in key]).alias("row_key"),
                F.md5(F.concat(*text).cast("binary")).alias("row_digest"),
            )
        )
    return _union(parts)


def _plain(rows: DataFrame) -> list[str]:
    """Columns whose values every engine writes alike: fractions differ in their last digits."""
    return [c for c, kind in rows.dtypes if not kind.startswith(("decimal", "double"))]


def _stored(store: TableStore, layer: str, names: Iterable[str]) -> DataFrame:
    return _digested({t: (store.read(f"{layer}.{t}"), SPECS[t].key) for t in names})


def _load_silver(store: TableStore, bronze: Callable[[str], DataFrame], now: AsOf) -> None:
    """The Silver tables, made in the store; also empty ones replace what was there."""
    silver = loads.silver_layer(store)
    for wave in loads.silver_waves():
        loads.each(wave, lambda t: store.replace(f"silver.{t}", cleanse(bronze(t), SPECS[t], silver, now)))


def _load_layers(w: Warehouse, store: TableStore, load: int) -> None:
    """Silver, profiles and dimensions of one load, made in the store from those before them: none is a copy of a kept table."""
    silver = loads.silver_layer(store)

    def load_profile(p: str) -> int:
        return store.replace(f"silver.{p}", PROFILES[p](silver, LOADS[load]))

    def load_dimension(d: str) -> int:
        spec, source = DIMENSIONS[d]
        before = store.read(f"gold.{d}") if store.exists(f"gold.{d}") else empty_dimension(silver[source], spec)
        return store.replace(f"gold.{d}", scd2_merge(before, silver[source], spec))

    _load_silver(store, lambda t: w.stored_bronze(t, load), LOADS[load])
    loads.each(PROFILES, load_profile)
    loads.each(DIMENSIONS, load_dimension)


def _append(w: Warehouse) -> DataFrame:
    """Every table: a full load, then a delta whose columns come in another order."""
    store = _store(w)
    for t in SOURCE_TABLES:
        store.replace_unless_empty(f"bronze.{t}", w.bronze_full(t))
        delta = w.bronze_delta(t)
        store.append(f"bronze.{t}", delta.select(*reversed(delta.columns)))
    return _stored(store, "bronze", SOURCE_TABLES)


def _append_rerun(w: Warehouse) -> DataFrame:
    """Every table: a batch, the same batch again after the source has grown, and an empty repeat of it."""
    store, sources = _store(w), {t: w.source(t, 2) for t in SOURCE_TABLES}
    early = {t: rows.where(F.pmod(F.xxhash64(*SPECS[t].key), F.lit(3)) != 0) for t, rows in sources.items()}
    loads.load_bronze_full(store, {t: w.source(t, 1) for t in SOURCE_TABLES}, LOADS[1], SOURCE_SYSTEM)
    for source in (early, sources, sources):
        loads.load_bronze_delta(store, source, NOW.ts, NOW, SOURCE_SYSTEM, batch="day 2")
    return _stored(store, "bronze", SOURCE_TABLES)


def _fact_refresh(w: Warehouse) -> DataFrame:
    """Every fact refreshed over an older content and an empty one."""
    store, parts = _store(w), []
    for name, (_, dimension, _, _) in facts.FACTS.items():
        fact, surrogate = w.fact_of_stretches(name), DIMENSIONS[dimension][0].surrogate
        store.replace(name, fact.where("date_key % 2 = 0"))
        store.replace(name, fact.where("false"))
        emptied = store.row_count(name)
        store.replace(name, fact)
        rows = _digested({name: (store.read(name), (surrogate, "date_key"))})
        parts.append(rows.withColumn("rows_after_empty_refresh", F.lit(emptied)))
    return _union(parts)


def _replace_unless_empty(w: Warehouse) -> DataFrame:
    """An empty refresh after a filled one: every Silver table keeps its rows."""
    store = _store(w)
    for t in SOURCE_TABLES:
        store.replace_unless_empty(f"silver.{t}", w.silver()[t])
        store.replace_unless_empty(f"silver.{t}", w.silver()[t].where("false"))
    return _stored(store, "silver", SOURCE_TABLES)


def _silver_changes(w: Warehouse) -> DataFrame:
    """Silver after a full load and a delta, the second time from the delta and the winners of the first."""
    store = _store(w)
    loads.load_bronze_full(store, {t: w.source(t, 1) for t in SOURCE_TABLES}, LOADS[1], SOURCE_SYSTEM)
    loads.load_silver_changes(store, LOADS[1])
    loads.load_bronze_delta(store, {t: w.source(t, 2) for t in SOURCE_TABLES}, NOW.ts, NOW, SOURCE_SYSTEM)
    loads.load_silver_changes(store, NOW)
    return _stored(store, "silver", SOURCE_TABLES)


def _dimension_loads(w: Warehouse) -> DataFrame:
    """All dimensions loaded twice through a store: every version with its period."""
    store = _store(w)
    for load in LOADS:
        for p in PROFILES:
            store.replace(f"silver.{p}", w.profile(p, load))
        loads.load_dimensions(store)
    parts = []
    for name, (spec, _) in DIMENSIONS.items():
        rows = store.read(f"gold.{name}")
        key = F.col(spec.key).cast("string").alias("business_key")
        version = F.col(spec.surrogate).alias("version_key")
        parts.append(rows.select(F.lit(name).alias("dimension"), version, key, "effective_from", "effective_to", "is_current"))
    return _union(parts)


def _fact_months(w: Warehouse) -> DataFrame:
    """The facts of the first load, then those of the second, of which only months that differ are written."""
    store = _store(w)
    for load, now in LOADS.items():
        _load_layers(w, store, load)
        loads.load_fact_months(store, now)
    surrogates = {name: DIMENSIONS[dimension][0].surrogate for name, (_, dimension, _, _) in facts.FACTS.items()}
    return _digested({name: (store.read(f"gold.{name}"), (key, "date_key")) for name, key in surrogates.items()})


def _missed_changes(w: Warehouse) -> DataFrame:
    """Every table: a full load before some rows were committed, a delta load after it, and what the two have missed."""
    store, now = _store(w), {t: w.source(t, 2) for t in SOURCE_TABLES}
    # Keys with remainder 3 come late.
    early = {t: w.source(t, 1).where(F.coalesce(F.col(SPECS[t].key[0]) % 11, F.lit(0)) != 3) for t in SOURCE_TABLES}
    loads.load_bronze_full(store, early, LOADS[1], SOURCE_SYSTEM)
    loads.load_bronze_delta(store, now, NOW.ts, NOW, SOURCE_SYSTEM)
    parts = []
    for t in SOURCE_TABLES:
        found = missed_changes(now[t], store.read(f"bronze.{t}"), SPECS[t].key, NOW.ts)
        key = F.concat_ws(",", *[F.col(k).cast("string") for k in SPECS[t].key]).alias("row_key")
        parts.append(found.select(F.lit(t).alias("table_name"), key, "source_changed", "bronze_changed"))
    return _union(parts)


def _rejects(w: Warehouse) -> DataFrame:
    """The dropped rows of all tables."""
    parts = []
    for name, spec in SPECS.items():
        parts.append(reject_reasons(w.stored_bronze(name), spec, w.silver(), NOW))
    return _union(parts)


def _reject_counts(w: Warehouse) -> DataFrame:
    """The load of rejects through a store: what the writes have counted, beside the rows they have left."""
    store = _store(w)
    loads.load_bronze_full(store, {t: w.source(t, 1) for t in SOURCE_TABLES}, LOADS[1], SOURCE_SYSTEM)
    loads.load_bronze_delta(store, {t: w.source(t, 2) for t in SOURCE_TABLES}, NOW.ts, NOW, SOURCE_SYSTEM)
    _load_silver(store, lambda t: store.read(f"bronze.{t}"), NOW)
    found = loads.load_rejects(store, NOW)
    rows = [(t, reason, n) for t, counts in found.items() for reason, n in counts.items()]
    counted = w.spark.createDataFrame(rows, "table_name string, reason string, counted bigint")
    stored = _union([store.read(f"rejects.{t}") for t in SOURCE_TABLES])
    kept = stored.groupBy("table_name", "reason").agg(F.count("*").alias("stored"))
    return counted.join(kept, ["table_name", "reason"], "full")


# -- dimensions --------------------------------------------------------------


def _latest(w: Warehouse, name: str) -> DataFrame:
    """Two loads that keep one profile row per business key."""
    spec, source = DIMENSIONS[name]
    first, second = w.profile(source, 1), w.profile(source, 2)
    before = w.keep(f"{name}_latest1", lambda: scd2_merge(empty_dimension(first, spec), first, spec, "latest"))
    return scd2_merge(before, second, spec, "latest")


def _changes(w: Warehouse) -> DataFrame:
    return _union(
        [
            scd2_changes(w.dimension(name, 1), w.profile(source, 2), spec).select(
                F.lit(name).alias("dimension"),
                F.col("business_key").cast("string").alias("business_key"),
                "change",
            )
            for name, (spec, source) in DIMENSIONS.items()
        ]
    )


# -- calendar, spines, measures ----------------------------------------------


def _dim_date(w: Warehouse) -> DataFrame:
    days = w.silver()["rental"].agg(F.min("rental_date"), F.max("rental_date")).first()
    return dim_date(w.spark, Calendar(*days))


def _spine(fact: str, step: str, period: str, *columns: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: spine(w.bounds(fact), step, period).select(*columns, period)


def _as_of(w: Warehouse) -> DataFrame:
    return as_of_join(
        w.bounds("fact_customer_daily_activity"),
        w.dimension("dim_customer"),
        "customer_no",
        "customer_sk",
        DAY,
        "full_date",
    ).select("customer_id", "customer_no", "customer_sk", "full_date")


def _payment_versions(w: Warehouse) -> DataFrame:
    """Each payment with the customer's version at its moment."""
    silver = w.silver()
    numbers = silver["customer"].select("customer_id", "customer_no")
    payments = silver["payment"].select("payment_id", "customer_id", "payment_date").join(numbers, "customer_id")
    found = as_of_events(
        payments, w.dimension("dim_customer"), "customer_no", "payment_date", "effective_from", "effective_to", "customer_sk"
    )
    return found.select("payment_id", "customer_no", "payment_date", "customer_sk")


def _measure(
    part: Callable[[Mapping[str, DataFrame]], DataFrame], period: str
) -> Callable[[Warehouse], DataFrame]:
    def query(w: Warehouse) -> DataFrame:
        rows = part(w.silver())
        entity = next(c for c in rows.columns if c.endswith("_id"))
        measures = [c for c in rows.columns if c not in (entity, "period")]
        summed = sum_contributions([rows], entity, measures)
        return summed.withColumnRenamed("period", period).fillna(0, measures)

    return query


def _rating(w: Warehouse) -> DataFrame:
    sums = sum_contributions(
        [facts.rating_months(w.silver())], "content_id", ["rating_sum", "rating_count"]
    )
    return sums.select(
        "content_id",
        F.col("period").alias("month_start"),
        facts.average_rating().alias("average_customer_rating"),
    )


# -- audit -------------------------------------------------------------------


def _closed_runs(w: Warehouse) -> DataFrame:
    opened = audit.open_runs(w.source("audit_run"))
    return audit.close_runs(opened, audit.roll_up(w.source("audit_task")), NOW.ts)


def _silver_metrics(w: Warehouse) -> DataFrame:
    return _union(
        [audit.load_metrics(t, w.bronze(t, 2), w.silver()[t]) for t in SOURCE_TABLES]
    )


def _dim_metrics(w: Warehouse) -> DataFrame:
    metrics = [
        audit.load_metrics(name, w.profile(source), w.profile(source))
        for name, (_, source) in DIMENSIONS.items()
    ]
    # A merge does not report inserts.
    return _union(metrics).withColumn("inserted_record_count", F.lit(0).cast("bigint"))


def _fact_expected(w: Warehouse) -> DataFrame:
    return _union(
        [
            audit.load_metrics_of(name, spine_size(w.bounds(name), step), w.fact(name))
            for name, (_, _, _, step) in facts.FACTS.items()
        ]
    )


# -- checks ------------------------------------------------------------------


def _per_dimension(w: Warehouse, check: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    parts = []
    for name, (spec, _) in DIMENSIONS.items():
        found = check(w.dimension(name), spec.key)
        rest = [c for c in found.columns if c != spec.key]
        key = F.col(spec.key).cast("string").alias("business_key")
        parts.append(found.select(F.lit(name).alias("dimension"), key, *rest))
    return _union(parts)


def _row_counts(w: Warehouse) -> DataFrame:
    tables = {("bronze", t): w.bronze(t, 2) for t in SOURCE_TABLES}
    tables |= {("silver", t): w.silver()[t] for t in SOURCE_TABLES}
    for name, (_, source) in DIMENSIONS.items():
        tables["profile", name.removeprefix("dim_")] = w.profile(source)
        tables["dim", name.removeprefix("dim_")] = w.dimension(name)
    for name in facts.FACTS:
        tables["fact", name.split("_")[1]] = w.fact(name)
    return checks.row_counts(tables)


def _rerun(w: Warehouse) -> DataFrame:
    parts = []
    for name, (spec, source) in DIMENSIONS.items():
        before = w.dimension(name)
        found = checks.state_difference(before, scd2_merge(before, w.profile(source), spec))
        parts.append(
            found.select(
                F.lit(name).alias("dimension"),
                F.col(spec.surrogate).alias("version_key"),
                F.col(spec.key).cast("string").alias("business_key"),
                "effective_from",
                "effective_to",
                "is_current",
                "surplus",
            )
        )
    return _union(parts)


def _rerun_digests(w: Warehouse) -> DataFrame:
    """Silver, dimensions and facts made and stored twice: are the states equal, by the digests their writes have noted?"""
    store, found = _store(w), []
    silver = loads.silver_layer(store)

    def again(table: str, rows: Callable[[], DataFrame]) -> tuple[str, int, bool]:
        first = store.digest(table)
        store.replace(table, rows())
        return table.removeprefix("silver."), first.rows, first == store.digest(table)

    def fact(name: str) -> tuple[str, int, bool]:
        build, dimension, _, _ = facts.FACTS[name]
        store.replace(name, build(silver, store.read(f"gold.{dimension}"), NOW))
        return again(name, lambda: build(silver, store.read(f"gold.{dimension}"), NOW))

    for name in DIMENSIONS:
        store.replace(f"gold.{name}", w.dimension(name, 1))
    _load_layers(w, store, 2)
    found += [fact(name) for name in facts.FACTS]
    for t, spec in SPECS.items():
        found.append(again(f"silver.{t}", lambda t=t, spec=spec: cleanse(w.stored_bronze(t), spec, silver, NOW)))
    firsts = {name: store.digest(f"gold.{name}") for name in DIMENSIONS}
    loads.load_dimensions(store)
    found += [(name, first.rows, first == store.digest(f"gold.{name}")) for name, first in firsts.items()]
    return w.spark.createDataFrame(found, "table_name string, row_count bigint, is_equal boolean")


def _fact_grain(w: Warehouse) -> DataFrame:
    parts = []
    for name, (_, dimension, _, _) in facts.FACTS.items():
        surrogate = DIMENSIONS[dimension][0].surrogate
        found = checks.repeated_grain(w.fact(name), (surrogate, "date_key"))
        key = F.col(surrogate).alias("version_key")
        parts.append(found.select(F.lit(name).alias("fact"), key, "date_key", "row_count"))
    return _union(parts)


def builders() -> dict[str, Callable[[Warehouse], DataFrame]]:
    found: dict[str, Callable[[Warehouse], DataFrame]] = {}
    for t in SOURCE_TABLES:
        found[f"bronze_full_{t}"] = lambda w, t=t: w.bronze_full(t)
        found[f"bronze_delta_{t}"] = lambda w, t=t: w.bronze_delta(t)
        found[f"silver_{t}"] = lambda w, t=t: w.silver_rows(t)
    for p in PROFILES:
        found[f"profile_{p.removesuffix('_profile')}"] = lambda w, p=p: w.profile_rows(p)
    for d in DIMENSIONS:
        found[d] = lambda w, d=d: w.dimension_rows(d, 1)
        found[f"{d}_second_load"] = lambda w, d=d: w.dimension_rows(d, 2)
        found[f"{d}_latest"] = lambda w, d=d: _latest(w, d)
    for f in facts.FACTS:
        found[f] = lambda w, f=f: w.fact_rows(f)
    by_day, by_month = "activity_date", "month_start"
    found |= {
        "bronze_watermark": _watermarks,
        "bronze_append": _append,
        "bronze_append_rerun": _append_rerun,
        "fact_refresh": _fact_refresh,
        "fact_months": _fact_months,
        "missed_changes": _missed_changes,
        "silver_changes": _silver_changes,
        "dim_loads": _dimension_loads,
        "replace_unless_empty": _replace_unless_empty,
        "reject_reasons": _rejects,
        "reject_counts": _reject_counts,
        "scd2_changes": _changes,
        "dim_date": _dim_date,
        "spine_customer_day": _spine(
            "fact_customer_daily_activity", DAY, "full_date", "customer_id", "customer_no"
        ),
        "spine_content_month": _spine(
            "fact_content_monthly_performance", MONTH, "month_start", "content_id"
        ),
        "spine_inventory_day": _spine(
            "fact_inventory_daily_utilization", DAY, "full_date", "inventory_id", "barcode"
        ),
        "scd2_as_of_join": _as_of,
        "as_of_payment_version": _payment_versions,
        "agg_stream_day": _measure(facts.stream_days, by_day),
        "agg_rental_day": _measure(
            lambda s: facts.rental_days(s, "customer_id", "physical_rental_count"), by_day
        ),
        "agg_return_day": _measure(
            lambda s: facts.return_days(s, "customer_id", "returned_item_count"), by_day
        ),
        "agg_payment_day": _measure(facts.payment_days, by_day),
        "agg_ticket_day": _measure(facts.ticket_days, by_day),
        "agg_stream_month": _measure(facts.stream_months, by_month),
        "agg_rental_month": _measure(facts.rental_months, by_month),
        "agg_revenue_month": _measure(facts.revenue_months, by_month),
        "agg_rating_month": _rating,
        "agg_wishlist_month": _measure(facts.wishlist_months, by_month),
        "agg_rental_item_day": _measure(
            lambda s: facts.rental_days(s, "inventory_id", "rental_count"), by_day
        ),
        "agg_return_item_day": _measure(
            lambda s: facts.return_days(s, "inventory_id", "return_count"), by_day
        ),
        "inventory_status_day": lambda w: facts.inventory_status(w.silver(), NOW),
        "audit_start": lambda w: audit.open_runs(w.source("audit_run")),
        "audit_rollup": lambda w: audit.roll_up(w.source("audit_task")),
        "audit_finish": _closed_runs,
        "audit_latest_runs": lambda w: audit.latest_runs(_closed_runs(w)),
        "audit_silver_metrics": _silver_metrics,
        "audit_dim_metrics": _dim_metrics,
        "audit_fact_expected": _fact_expected,
        "check_fact_grain": _fact_grain,
        "check_scd2_versions": lambda w: _per_dimension(w, checks.version_counts),
        "check_scd2_intervals": lambda w: _per_dimension(w, checks.overlapping_versions),
        "check_row_counts": _row_counts,
        "check_rerun_equal": _rerun,
        "check_rerun_digests": _rerun_digests,
    }
    return found


def registered() -> dict[str, Query]:
    def bind(build: Callable[[Warehouse], DataFrame]) -> Query:
        return lambda spark, folder: comparable(build(warehouse(spark, folder)))

    return {name: bind(build) for name, build in builders().items()}
