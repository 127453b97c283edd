from __future__ import annotations

import datetime as dt
import itertools

from siltstone.functions.dates import AsOf
from siltstone.sources import delta_extract, full_extract, last_watermark
from siltstone.sources.jdbc import Split, read_options

SCHEMA = "id bigint, created_at timestamp_ntz, updated_at timestamp_ntz"
NOW = AsOf(dt.datetime(2024, 1, 10))


def day(n):
    return None if n is None else dt.datetime(2024, 1, n)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_full_extract_adds_lineage_and_keeps_everything(rows_of):
    source = rows_of(SCHEMA, (1, day(1), None), (2, None, None), (3, day(20), day(20)))
    rows = full_extract(source, NOW, "crm").collect()
    assert len(rows) == 3
    assert {(r.load_timestamp, r.source_system) for r in rows} == {(NOW.ts, "crm")}


def test_watermark(rows_of):
    assert last_watermark(rows_of(SCHEMA)) == dt.datetime(1900, 1, 1)
    assert last_watermark(rows_of(SCHEMA, (1, None, None))) == dt.datetime(1900, 1, 1)
    assert last_watermark(rows_of(SCHEMA, (1, day(4), None), (2, day(1), day(3)))) == day(4)


def test_delta_equals_its_definition_for_every_combination_of_nulls(rows_of):
    times = [None, 1, 2, 3, 4, 5]
    rows = [
        (i, day(c), day(u)) for i, (c, u) in enumerate(itertools.product(times, times), start=1)
    ]
    low, high = day(2), day(4)
    expected = []
    for i, created, updated in rows:
        known = [t for t in (created, updated) if t]
        if known and low < max(known) <= high:
            expected.append(i)
    assert ids(delta_extract(rows_of(SCHEMA, *rows), low, high, NOW, "crm")) == expected


def test_consecutive_windows_do_not_overlap_and_leave_no_gap(rows_of):
    rows = [(i, day(1), day(i)) for i in range(1, 9)]
    source = rows_of(SCHEMA, *rows)
    edges = [day(1), day(3), day(4), day(8)]
    windows = [ids(delta_extract(source, a, b, NOW, "crm")) for a, b in itertools.pairwise(edges)]
    assert windows == [[2, 3], [4], [5, 6, 7, 8]]


def test_future_row_of_a_full_load_hides_later_changes(rows_of):
    bronze = full_extract(rows_of(SCHEMA, (1, day(1), day(30))), NOW, "crm")
    source = rows_of(SCHEMA, (1, day(1), day(30)), (2, day(9), day(9)))
    assert ids(delta_extract(source, last_watermark(bronze), day(10), NOW, "crm")) == []


def test_delta_filter_reaches_the_scan(spark, rows_of, tmp_path):
    rows_of(SCHEMA, (1, day(1), day(2))).write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = delta_extract(source, day(1), day(2), NOW, "crm")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThan(created_at" in pushed and "LessThanOrEqual(updated_at" in pushed


def test_jdbc_options_split_the_scan():
    split = Split("rental_id", "0", "1000000", 64)
    options = read_options("jdbc:x", "rental", {"user": "u"}, split, 500)
    assert options["partitionColumn"] == "rental_id" and options["numPartitions"] == "64"
    assert options["fetchsize"] == "500" and options["user"] == "u"
    assert "partitionColumn" not in read_options("jdbc:x", "rental", {}, None, 500)
