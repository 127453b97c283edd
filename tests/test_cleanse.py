from __future__ import annotations

import datetime as dt

import pytest

from siltstone.functions.dates import AsOf
from siltstone.operators.cleanse import cleanse
from siltstone.operators.dedupe import latest_version, unique_only
from siltstone.plans.loads import silver_waves
from siltstone.plans.silver import SPECS

NOW = AsOf(dt.datetime(2024, 3, 31))
LINEAGE = "created_at timestamp_ntz, updated_at timestamp_ntz, load_timestamp timestamp_ntz, source_system string"


def day(n, month=1):
    return dt.datetime(2024, month, n)


def stamped(*values, created=day(1), updated=day(2), loaded=day(3)):
    return (*values, created, updated, loaded, "S")


def keys(df):
    return sorted(r[0] for r in df.collect())


def test_latest_version_orders_nulls_as_defined(rows_of):
    schema = f"id bigint, v string, {LINEAGE}"
    df = rows_of(
        schema,
        stamped(1, "null update", updated=None),
        stamped(1, "newest", updated=day(9)),
        stamped(1, "older", updated=day(8)),
        stamped(2, "loaded", loaded=day(9)),
        stamped(2, "load unknown", loaded=None),
        stamped(3, "b"),
        stamped(3, "a"),
        stamped(None, "no key"),
    )
    found = {r.id: r.v for r in latest_version(df, ["id"]).collect()}
    assert found == {1: "newest", 2: "load unknown", 3: "a"}


def test_group_limit_runs_before_the_shuffle(rows_of):
    df = latest_version(rows_of(f"id bigint, v string, {LINEAGE}"), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_unique_only_drops_all_copies(rows_of):
    df = rows_of("id bigint, b string", (1, "x"), (2, "x"), (3, "y"), (4, None), (5, "x"))
    assert keys(unique_only(df, "b")) == [3]


def content_row(i, title="T", kind=1, released=dt.date(2023, 1, 1), minutes=5, **times):
    return stamped(i, kind, title, released, minutes, "english", "pg", **times)


CONTENT = (
    "content_id bigint, content_type_id bigint, title string, release_date date,"
    f" duration_minutes int, language string, age_rating string, {LINEAGE}"
)


def test_rules_apply_to_the_newest_version_only(spark, rows_of):
    bronze = rows_of(
        CONTENT,
        content_row(1),
        content_row(2, updated=day(2)),
        content_row(2, title=" ", updated=day(5)),
        content_row(3, kind=9),
        content_row(4, released=dt.date(2024, 4, 1)),
        content_row(5, released=NOW.ts.date()),
        content_row(6, minutes=-1),
        content_row(7, minutes=None),
        content_row(8, updated=day(1, 12)),
        content_row(9, created=day(5), updated=day(4)),
        content_row(10, created=None, updated=None),
        content_row(11, released=None),
    )
    parents = {"content_type": rows_of("content_type_id bigint", (1,))}
    silver = cleanse(bronze, SPECS["content"], parents, NOW)
    assert keys(silver) == [1, 5, 7, 10]
    first = silver.where("content_id = 1").first()
    assert (first.title, first.language, first.age_rating) == ("T", "English", "PG")
    assert silver.columns == [*SPECS["content"].columns, "created_at", "updated_at", "load_timestamp", "source_system"]


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_optional_reference(spark, rows_of, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        bronze = rows_of(
            f"warehouse_id bigint, city_id bigint, warehouse_name string, {LINEAGE}",
            stamped(1, None, "a"),
            stamped(2, 7, "b"),
            stamped(3, 8, None),
        )
        parents = {"city": rows_of("city_id bigint", (7,), (1,))}
        assert keys(cleanse(bronze, SPECS["warehouse"], parents, NOW)) == [1, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_barcode_is_compared_with_rows_that_fail_other_rules(rows_of):
    bronze = rows_of(
        "inventory_id bigint, content_id bigint, warehouse_id bigint, barcode string,"
        f" purchase_date date, item_condition string, status string, {LINEAGE}",
        stamped(1, 1, 1, "A", None, "good", "in"),
        stamped(2, 1, 1, " A ", None, None, "in"),
        stamped(3, 1, 1, "B", None, "good", "in"),
        stamped(4, 1, 1, "C", None, "good", "in", updated=day(2)),
        stamped(4, 1, 1, "D", None, "good", "in", updated=day(3)),
        stamped(5, 1, 1, "C", None, "good", "in"),
        stamped(6, 1, 1, None, None, "good", "in"),
    )
    parents = {
        "content": rows_of("content_id bigint", (1,)),
        "warehouse": rows_of("warehouse_id bigint", (1,)),
    }
    assert keys(cleanse(bronze, SPECS["inventory_item"], parents, NOW)) == [3, 4, 5]


def test_customer_dates(rows_of):
    def customer(i, born, registered):
        return stamped(i, f"C{i}", "A", "B", None, None, born, None, registered, None)

    bronze = rows_of(
        "customer_id bigint, customer_no string, first_name string, last_name string, email string,"
        " phone string, date_of_birth date, gender string, registration_date date, status string,"
        f" {LINEAGE}",
        customer(1, None, None),
        customer(2, dt.date(2000, 1, 1), None),
        customer(3, dt.date(2000, 1, 1), dt.date(1999, 1, 1)),
        customer(4, dt.date(2030, 1, 1), None),
        customer(5, None, dt.date(2024, 4, 1)),
        customer(6, None, dt.date(2024, 3, 31)),
    )
    assert keys(cleanse(bronze, SPECS["customer"], {}, NOW)) == [1, 2, 6]


def test_hot_and_null_references_keep_every_row(spark, rows_of):
    """A third of the rows points to one parent and a third to none."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bronze = spark.range(3000).selectExpr(
            "id AS address_id",
            "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 50 END AS customer_id",
            "CASE WHEN id % 3 = 1 THEN NULL ELSE id % 10 END AS city_id",
            "'line' AS address_line",
            "CAST(NULL AS STRING) AS postal_code",
            "'HOME' AS address_type",
            "timestamp_ntz'2024-01-01' AS created_at",
            "timestamp_ntz'2024-01-01' AS updated_at",
            "timestamp_ntz'2024-01-01' AS load_timestamp",
            "'S' AS source_system",
        )
        parents = {
            "customer": spark.range(40).withColumnRenamed("id", "customer_id"),
            "city": spark.range(5).withColumnRenamed("id", "city_id"),
        }
        expected = 0
        for i in range(3000):
            customer = 1 if i % 3 == 0 else i % 50
            city = None if i % 3 == 1 else i % 10
            expected += customer < 40 and (city is None or city < 5)
        assert cleanse(bronze, SPECS["customer_address"], parents, NOW).count() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_waves_respect_references():
    done = set()
    for wave in silver_waves():
        for name in wave:
            assert done.issuperset(SPECS[name].parents)
        done.update(wave)
    assert done == set(SPECS) and len(SPECS) == 16
