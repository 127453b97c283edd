"""The three dense facts and the measures they are made of."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.dates import AsOf, Calendar, date_key
from siltstone.operators.asof import version_spans
from siltstone.operators.calendar import DAY, MONTH, spine_bounds
from siltstone.operators.densify import contribution, densify, stretches, sum_contributions

Silver = Mapping[str, DataFrame]
# What may be left out before a fact is expanded.
Choice = Callable[["DenseFact", DataFrame], DataFrame]

# Spine start where a date is missing, completed-payment status.
FALLBACK_START = "2023-01-01"
COMPLETED = "COMPLETED"


def _count() -> Column:
    return F.lit(1).cast("bigint")


def _fallback() -> Column:
    return F.lit(FALLBACK_START).cast("date")


# -- spines ---------------------------------------------------------------


def customer_days(silver: Silver, as_of: AsOf, calendar: Calendar | None = None) -> DataFrame:
    """Bounds of customer x day, from registration to today."""
    customers = silver["customer"].select("customer_id", "customer_no", "registration_date")
    start = F.coalesce("registration_date", _fallback())
    return spine_bounds(customers, start, as_of, DAY, calendar).drop("registration_date")


def content_months(silver: Silver, as_of: AsOf, calendar: Calendar | None = None) -> DataFrame:
    """Bounds of title x month, from release (not before the fallback) to this month."""
    titles = silver["content"].select("content_id", "release_date")
    released = F.coalesce(F.trunc("release_date", "MM"), _fallback())
    start = F.greatest(released, _fallback())
    return spine_bounds(titles, start, as_of, MONTH, calendar).drop("release_date")


def inventory_days(silver: Silver, as_of: AsOf, calendar: Calendar | None = None) -> DataFrame:
    """Bounds of item x day, from purchase to today."""
    items = silver["inventory_item"].where("barcode IS NOT NULL")
    items = items.select("inventory_id", "barcode", "purchase_date")
    start = F.coalesce("purchase_date", _fallback())
    return spine_bounds(items, start, as_of, DAY, calendar).drop("purchase_date")


# -- measures by customer and day ------------------------------------------


def stream_days(silver: Silver) -> DataFrame:
    return contribution(
        silver["streaming_session"],
        "customer_id",
        F.to_date("start_time"),
        {
            "stream_session_count": _count(),
            "total_stream_duration_mins": F.col("watch_duration").cast("bigint"),
        },
    )


def rental_days(silver: Silver, entity: str, measure: str) -> DataFrame:
    return contribution(silver["rental"], entity, F.col("rental_date"), {measure: _count()})


def return_days(silver: Silver, entity: str, measure: str) -> DataFrame:
    return contribution(silver["rental"], entity, F.col("return_date"), {measure: _count()})


def payment_days(silver: Silver) -> DataFrame:
    # Silver holds upper-case status only, so the comparison needs no UPPER
    # and reaches the scan.
    completed = silver["payment"].where(F.col("status") == COMPLETED)
    return contribution(
        completed, "customer_id", F.to_date("payment_date"), {"total_amount_spent": F.col("amount")}
    )


def ticket_days(silver: Silver) -> DataFrame:
    return contribution(
        silver["support_ticket"],
        "customer_id",
        F.to_date("opened_date"),
        {"support_ticket_count": _count()},
    )


# -- measures by title and month --------------------------------------------


def _month(c: str) -> Column:
    return F.trunc(c, "MM")


def stream_months(silver: Silver) -> DataFrame:
    return contribution(
        silver["streaming_session"],
        "content_id",
        _month("start_time"),
        {"total_streams": _count()},
    )


def rental_months(silver: Silver) -> DataFrame:
    """Rentals by title; summed per item before the join, so no item is hot in it."""
    per_item = sum_contributions(
        [
            contribution(
                silver["rental"],
                "inventory_id",
                _month("rental_date"),
                {"total_rental_count": _count()},
            )
        ],
        "inventory_id",
        ["total_rental_count"],
    )
    return _by_title(per_item, silver)


def revenue_months(silver: Silver) -> DataFrame:
    """Completed payments by title and month of payment, through rental and item."""
    completed = silver["payment"].where(
        (F.col("status") == COMPLETED) & F.col("rental_id").isNotNull()
    )
    paid = contribution(
        completed, "rental_id", _month("payment_date"), {"revenue_generated": F.col("amount")}
    )
    rentals = silver["rental"].select("rental_id", "inventory_id")
    # A rental has about one payment, so summing up before the join would only shuffle twice.
    per_item = (
        paid.join(rentals, "rental_id")
        .groupBy("inventory_id", "period")
        .agg(F.sum("revenue_generated").alias("revenue_generated"))
    )
    return _by_title(per_item, silver)


def _by_title(per_item: DataFrame, silver: Silver) -> DataFrame:
    titles = silver["inventory_item"].select("inventory_id", "content_id")
    return per_item.join(titles, "inventory_id").drop("inventory_id")


def rating_months(silver: Silver) -> DataFrame:
    """Sum and count, so that the average can still be taken after any merge."""
    rated = silver["review"].where("rating IS NOT NULL")
    return contribution(
        rated,
        "content_id",
        _month("review_date"),
        {"rating_sum": F.col("rating"), "rating_count": _count()},
    )


def average_rating() -> Column:
    return F.col("rating_sum").cast("double") / F.nullif(F.col("rating_count"), F.lit(0))


def wishlist_months(silver: Silver) -> DataFrame:
    return contribution(
        silver["wishlist"],
        "content_id",
        _month("added_date"),
        {"wishlist_addition_count": _count()},
    )


# -- rentals, both ends of them ------------------------------------------------


def rental_ends(
    silver: Silver, entity: str, out: str, back: str, open_rentals: str | None = None
) -> DataFrame:
    """Rentals and returns from one scan: a row for each end of each rental.

    ``open_rentals`` is +1 when an item goes out and -1 when it is back. A
    rental covers ``[rental_date, return_date)``; the running total per item
    tells on each day whether any rental covers it, without listing the days
    of each rental and without comparing days with rentals. Rentals returned
    on their first day, or before it, cover no day and change nothing.
    """
    covers = F.col("return_date").isNull() | (F.col("return_date") > F.col("rental_date"))
    change = F.when(covers, F.lit(1)).otherwise(0).cast("bigint")
    none = F.lit(None).cast("bigint")

    def end(day: str, went: Column, came: Column, sign: int) -> Column:
        fields = [F.col(day).alias("period"), went.alias(out), came.alias(back)]
        if open_rentals:
            fields.append((change * sign).cast("bigint").alias(open_rentals))
        return F.struct(*fields)

    ends = F.array(
        end("rental_date", _count(), none, 1), end("return_date", none, _count(), -1)
    )
    return silver["rental"].select(entity, F.inline(ends)).where("period IS NOT NULL")


# -- occupancy ---------------------------------------------------------------


def inventory_status(
    silver: Silver, as_of: AsOf, calendar: Calendar | None = None
) -> DataFrame:
    """Item x day with ``is_utilised`` 0 or 1."""
    bounded = inventory_days(silver, as_of, calendar)
    ends = rental_ends(silver, "inventory_id", "rental_count", "return_count", "open_rentals")
    ends = ends.select("inventory_id", "period", "open_rentals")
    parts = _within([ends], as_of, calendar, ("open_rentals",))
    active = stretches(bounded, parts, "inventory_id", (), ("open_rentals",))
    dense = densify(bounded, active, "inventory_id", DAY, "full_date", (), ("open_rentals",))
    return dense.select(
        "inventory_id", "barcode", "full_date", _utilised().cast("int").alias("is_utilised")
    )


def _utilised() -> Column:
    return F.col("open_rentals") > 0


# -- facts --------------------------------------------------------------------


def _within(
    parts: Sequence[DataFrame], as_of: AsOf, calendar: Calendar | None, carried: Sequence[str] = ()
) -> list[DataFrame]:
    """Drop activity outside all spines before it is shuffled.

    Changes of a carried column from before the calendar still count from its
    first day on; they move there, so they collapse into one row per entity.
    """
    found = []
    for part in parts:
        part = part.where(F.col("period") <= as_of.date)
        if calendar is None:
            found.append(part)
            continue
        first = F.lit(calendar.first)
        inside = F.col("period") >= first
        if not set(carried).intersection(part.columns):
            found.append(part.where(inside))
            continue
        entity, *rest = [c for c in part.columns if c != "period"]
        columns = [F.col(c) if c in carried else F.when(inside, F.col(c)).alias(c) for c in rest]
        found.append(part.select(entity, F.greatest("period", first).alias("period"), *columns))
    return found


def _or_zero(column: str, kind: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast(kind).alias(column)


@dataclass(frozen=True)
class DenseFact:
    """Everything a periodic snapshot differs in.

    With ``cluster`` the rows of one month are written together, so filters on
    ``date_key`` skip most files by their statistics.
    """

    surrogate: str
    business_key: str
    entity: str
    step: str
    measures: tuple[str, ...]
    carried: tuple[str, ...] = ()

    def build(
        self,
        bounded: DataFrame,
        dimension: DataFrame,
        parts: Sequence[DataFrame],
        as_of: AsOf,
        calendar: Calendar | None,
        cluster: bool,
        choose: Choice | None,
    ) -> DataFrame:
        parts = _within(parts, as_of, calendar, self.carried)
        active = stretches(bounded, parts, self.entity, self.measures, self.carried)
        spans = version_spans(bounded, dimension, self.business_key, self.surrogate, self.step)
        spans = spans.select(self.entity, self.surrogate, "first_period", "last_period")
        chosen = (lambda met: choose(self, met)) if choose else None
        return densify(
            spans, active, self.entity, self.step, "full_date", self.measures, self.carried, cluster, chosen
        ).withColumn("date_key", date_key(F.col("full_date")))


CUSTOMER_DAY = DenseFact(
    surrogate="customer_sk",
    business_key="customer_no",
    entity="customer_id",
    step=DAY,
    measures=(
        "stream_session_count",
        "total_stream_duration_mins",
        "physical_rental_count",
        "returned_item_count",
        "total_amount_spent",
        "support_ticket_count",
    ),
)
CONTENT_MONTH = DenseFact(
    surrogate="content_sk",
    business_key="content_id",
    entity="content_id",
    step=MONTH,
    measures=(
        "total_streams",
        "total_rental_count",
        "revenue_generated",
        "rating_sum",
        "rating_count",
        "wishlist_addition_count",
    ),
)
INVENTORY_DAY = DenseFact(
    surrogate="inventory_sk",
    business_key="barcode",
    entity="inventory_id",
    step=DAY,
    measures=("rental_count", "return_count"),
    carried=("open_rentals",),
)


def fact_customer_daily_activity(
    silver: Silver,
    dimension: DataFrame,
    as_of: AsOf,
    calendar: Calendar | None = None,
    cluster: bool = False,
    choose: Choice | None = None,
) -> DataFrame:
    parts = [
        stream_days(silver),
        rental_ends(silver, "customer_id", "physical_rental_count", "returned_item_count"),
        payment_days(silver),
        ticket_days(silver),
    ]
    bounded = customer_days(silver, as_of, calendar)
    dense = CUSTOMER_DAY.build(bounded, dimension, parts, as_of, calendar, cluster, choose)
    return dense.select(
        "customer_sk",
        "date_key",
        _or_zero("stream_session_count", "bigint"),
        _or_zero("total_stream_duration_mins", "bigint"),
        _or_zero("physical_rental_count", "bigint"),
        _or_zero("returned_item_count", "bigint"),
        _or_zero("total_amount_spent", "decimal(18,2)"),
        _or_zero("support_ticket_count", "bigint"),
    )


def fact_content_monthly_performance(
    silver: Silver,
    dimension: DataFrame,
    as_of: AsOf,
    calendar: Calendar | None = None,
    cluster: bool = False,
    choose: Choice | None = None,
) -> DataFrame:
    parts = [
        stream_months(silver),
        rental_months(silver),
        revenue_months(silver),
        rating_months(silver),
        wishlist_months(silver),
    ]
    bounded = content_months(silver, as_of, calendar)
    dense = CONTENT_MONTH.build(bounded, dimension, parts, as_of, calendar, cluster, choose)
    return dense.withColumn("average_customer_rating", average_rating()).select(
        "content_sk",
        "date_key",
        _or_zero("total_streams", "bigint"),
        _or_zero("total_rental_count", "bigint"),
        _or_zero("revenue_generated", "decimal(18,2)"),
        _or_zero("average_customer_rating", "double"),
        _or_zero("wishlist_addition_count", "bigint"),
    )


def fact_inventory_daily_utilization(
    silver: Silver,
    dimension: DataFrame,
    as_of: AsOf,
    calendar: Calendar | None = None,
    cluster: bool = False,
    choose: Choice | None = None,
) -> DataFrame:
    parts = [
        rental_ends(silver, "inventory_id", "rental_count", "return_count", "open_rentals")
    ]
    bounded = inventory_days(silver, as_of, calendar)
    dense = INVENTORY_DAY.build(bounded, dimension, parts, as_of, calendar, cluster, choose)
    return dense.select(
        "inventory_sk",
        "date_key",
        _or_zero("rental_count", "bigint"),
        _or_zero("return_count", "bigint"),
        F.when(_utilised(), 0).otherwise(1).alias("days_available"),
        F.when(_utilised(), 100).otherwise(0).cast("decimal(5,2)").alias("utilisation_percentage"),
    )


# Fact, the dimension it looks up, its spine bounds, and the spine's step.
FACTS = {
    "fact_customer_daily_activity": (
        fact_customer_daily_activity,
        "dim_customer",
        customer_days,
        DAY,
    ),
    "fact_content_monthly_performance": (
        fact_content_monthly_performance,
        "dim_content",
        content_months,
        MONTH,
    ),
    "fact_inventory_daily_utilization": (
        fact_inventory_daily_utilization,
        "dim_inventory_item",
        inventory_days,
        DAY,
    ),
}
