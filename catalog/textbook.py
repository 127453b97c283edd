"""The usual way to write some operators, to measure the library's form against.

Nothing else uses these. They give the same rows with joins on ranges, with
one join per measure, or with filters the scan cannot use.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.dates import AsOf, Calendar, ntz
from siltstone.operators.calendar import DAY, dim_date, spine
from siltstone.operators.densify import sum_contributions
from siltstone.plans import facts

Silver = Mapping[str, DataFrame]


def customer_days_by_range_join(silver: Silver, as_of: AsOf) -> DataFrame:
    customers = silver["customer"]
    start = F.coalesce("registration_date", F.lit("2023-01-01").cast("date"))
    first = customers.select(F.min(start)).first()[0]
    days = dim_date(customers.sparkSession, Calendar(first, as_of.ts.date()))
    return customers.join(days, F.col("full_date") >= start).select(
        "customer_id", "customer_no", "full_date"
    )


def customer_fact_by_joins(silver: Silver, dimension: DataFrame, as_of: AsOf) -> DataFrame:
    """Explode first, then the as-of lookup and one join per measure."""
    rows = spine(facts.customer_days(silver, as_of), DAY, "full_date")
    end = F.col("full_date").cast("timestamp_ntz") + F.expr(
        "INTERVAL '1' DAY - INTERVAL '0.000001' SECOND"
    )
    rows = rows.join(dimension, "customer_no").where(
        (end >= F.col("effective_from")) & (end < F.col("effective_to"))
    )
    parts = {
        "stream_session_count": facts.stream_days(silver),
        "physical_rental_count": facts.rental_days(silver, "customer_id", "physical_rental_count"),
        "returned_item_count": facts.return_days(silver, "customer_id", "returned_item_count"),
        "total_amount_spent": facts.payment_days(silver),
        "support_ticket_count": facts.ticket_days(silver),
    }
    measures = list(facts.CUSTOMER_DAY.measures)
    for part in parts.values():
        own = [c for c in part.columns if c in measures]
        summed = sum_contributions([part], "customer_id", own)
        rows = rows.join(
            summed.withColumnRenamed("period", "full_date"), ["customer_id", "full_date"], "left"
        )
    return rows.select("customer_sk", "full_date", *[F.coalesce(m, F.lit(0)).alias(m) for m in measures])


def inventory_status_by_exists(silver: Silver, as_of: AsOf) -> DataFrame:
    """For each item and day, look for a rental that covers the day."""
    days = spine(facts.inventory_days(silver, as_of), DAY, "full_date")
    spark = days.sparkSession
    return spark.sql(
        """
        SELECT inventory_id, barcode, full_date, CASE WHEN EXISTS (
            SELECT 1 FROM {rental} r WHERE r.inventory_id = d.inventory_id
            AND r.rental_date <= d.full_date AND (r.return_date IS NULL OR r.return_date > d.full_date)
        ) THEN 1 ELSE 0 END AS is_utilised FROM {days} d""",
        rental=silver["rental"],
        days=days,
    )


def changed_by_greatest(source: DataFrame, after: dt.datetime, until: dt.datetime) -> DataFrame:
    newest = F.greatest("created_at", "updated_at")
    return source.where((newest > ntz(after)) & (newest <= ntz(until)))
