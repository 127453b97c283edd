"""Denormalised Silver profiles.

Each keeps the change times and the source of its driving row, so a change in
a joined parent does not move ``updated_at``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.dates import AsOf, whole_years
from siltstone.functions.text import blank_to_null


def _with_lineage(rows: DataFrame, as_of: AsOf, *columns: str) -> DataFrame:
    return rows.select(
        *columns,
        "created_at",
        "updated_at",
        as_of.timestamp.alias("load_timestamp"),
        "source_system",
    )


def customer_profile(silver: Mapping[str, DataFrame], as_of: AsOf) -> DataFrame:
    """One row per customer and HOME address, or one without a place."""
    names = [blank_to_null(F.col(c)) for c in ("first_name", "last_name")]
    customers = silver["customer"].select(
        "customer_id",
        "customer_no",
        F.concat_ws(" ", *names).alias("full_name"),
        "email",
        whole_years(F.col("date_of_birth"), as_of.date).alias("age"),
        "status",
        "created_at",
        "updated_at",
        "source_system",
    )
    # Cities learn their country first, so addresses take part in one join.
    places = (
        silver["city"]
        .select("city_id", "city_name", "country_id")
        .join(silver["country"].select("country_id", "country_name"), "country_id", "left")
        .drop("country_id")
    )
    homes = (
        silver["customer_address"]
        .where("address_type = 'HOME'")
        .select("customer_id", "city_id")
        .join(places, "city_id", "left")
        .drop("city_id")
    )
    # A left join cannot split a customer that has very many addresses, an
    # inner join can; the rest of the customers come from an anti join on
    # the distinct ids.
    housed = customers.join(homes, "customer_id")
    with_home = homes.select("customer_id").distinct()
    unhoused = customers.join(with_home, "customer_id", "left_anti")
    rows = housed.unionByName(unhoused, allowMissingColumns=True)
    return _with_lineage(
        rows,
        as_of,
        "customer_id",
        "customer_no",
        "full_name",
        "email",
        "age",
        "city_name",
        "country_name",
        "status",
    )


def content_profile(silver: Mapping[str, DataFrame], as_of: AsOf) -> DataFrame:
    """One row per title; the primary genre is the known one with the lowest id."""
    genre = silver["genre"].select("genre_id", F.col("genre_name").alias("primary_genre"))
    # Only ids are aggregated, which stays in fixed-width hash maps.
    primary = (
        silver["content_genre"]
        .select("content_id", "genre_id")
        .join(genre.select("genre_id"), "genre_id", "left_semi")
        .groupBy("content_id")
        .agg(F.min("genre_id").alias("genre_id"))
        .join(genre, "genre_id")
        .drop("genre_id")
    )
    types = silver["content_type"].select(
        "content_type_id", F.col("content_type").alias("content_type_name")
    )
    rows = (
        silver["content"]
        .join(types, "content_type_id", "left")
        .join(primary, "content_id", "left")
        .withColumn("release_year", F.year("release_date"))
    )
    return _with_lineage(
        rows, as_of, "content_id", "title", "content_type_name", "primary_genre", "release_year"
    )


def inventory_item_profile(silver: Mapping[str, DataFrame], as_of: AsOf) -> DataFrame:
    titles = silver["content"].select("content_id", F.col("title").alias("content_title"))
    cities = silver["city"].select("city_id", F.col("city_name").alias("warehouse_city"))
    places = (
        silver["warehouse"]
        .select("warehouse_id", "city_id", "warehouse_name")
        .join(cities, "city_id", "left")
        .drop("city_id")
    )
    rows = (
        silver["inventory_item"]
        .join(titles, "content_id", "left")
        .join(places, "warehouse_id", "left")
    )
    return _with_lineage(
        rows,
        as_of,
        "inventory_id",
        "barcode",
        "content_title",
        "warehouse_name",
        "warehouse_city",
        "item_condition",
    )


PROFILES = {
    "customer_profile": customer_profile,
    "content_profile": content_profile,
    "inventory_item_profile": inventory_item_profile,
}
