"""The three versioned dimensions. Anchors are fixed values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.dates import ntz
from siltstone.operators.scd2 import ScdSpec

DIM_CUSTOMER = ScdSpec(
    name="dim_customer",
    surrogate="customer_sk",
    key="customer_no",
    tracked=("full_name", "email", "age", "city_name", "country_name", "status"),
    anchor=dt.datetime(2023, 1, 1),
)
DIM_CONTENT = ScdSpec(
    name="dim_content",
    surrogate="content_sk",
    key="content_id",
    tracked=("title", "content_type_name", "primary_genre", "release_year"),
    anchor=dt.datetime(2023, 1, 1),
)
DIM_INVENTORY_ITEM = ScdSpec(
    name="dim_inventory_item",
    surrogate="inventory_sk",
    key="barcode",
    tracked=("content_title", "warehouse_name", "warehouse_city", "item_condition"),
    anchor=dt.datetime(2018, 1, 1),
)

# Dimension and the profile that feeds it.
DIMENSIONS: dict[str, tuple[ScdSpec, str]] = {
    "dim_customer": (DIM_CUSTOMER, "customer_profile"),
    "dim_content": (DIM_CONTENT, "content_profile"),
    "dim_inventory_item": (DIM_INVENTORY_ITEM, "inventory_item_profile"),
}


def empty_dimension(profile: DataFrame, spec: ScdSpec) -> DataFrame:
    """A dimension without rows, typed after its profile; reads no data."""
    nothing = profile.where(F.lit(False))
    added = {
        spec.surrogate: F.lit(None).cast("bigint"),
        "effective_from": ntz(spec.anchor),
        "effective_to": ntz(spec.anchor),
        "is_current": F.lit(True),
    }
    return nothing.withColumns(added).select(*spec.columns)
