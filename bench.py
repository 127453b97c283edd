"""Time the headline queries and a complete load; prints one JSON line.

    BENCH_SF_DIR  folder of the given tables (default sf0.1)
    BENCH_CPUS    local threads (default 8)

``--compare`` also times the textbook forms of some operators.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import textbook  # noqa: E402
from catalog.registry import LOADS, NOW, SOURCE_SYSTEM, builders, warehouse  # noqa: E402
from catalog.shapes import SOURCE_TABLES  # noqa: E402
from siltstone.operators.calendar import DAY, spine  # noqa: E402
from siltstone.plans import facts, loads  # noqa: E402
from siltstone.session import Stage, configure  # noqa: E402
from siltstone.sources import TableStore  # noqa: E402
from siltstone.sources.extract import changed_between  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "bronze_full_rental",
    "bronze_delta_rental",
    "silver_customer",
    "silver_inventory_item",
    "silver_rental",
    "silver_payment",
    "silver_streaming_session",
    "profile_customer",
    "profile_content",
    "dim_customer",
    "dim_customer_second_load",
    "dim_inventory_item_second_load",
    "scd2_changes",
    "spine_customer_day",
    "scd2_as_of_join",
    "agg_rental_month",
    "agg_revenue_month",
    "inventory_status_day",
    "fact_customer_daily_activity",
    "fact_content_monthly_performance",
    "fact_inventory_daily_utilization",
    "audit_latest_runs",
    "check_fact_grain",
)


def run(rows: DataFrame) -> None:
    """Compute every row and column, and keep none."""
    rows.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def load_times(spark: SparkSession) -> dict[str, float]:
    """A first and a second day of the whole warehouse, written to a store."""
    w = warehouse(spark, FOLDER)
    store = TableStore(spark, Stage(spark).root)
    first = {t: w.source(t, 1) for t in SOURCE_TABLES}
    second = {t: w.source(t, 2) for t in SOURCE_TABLES}
    day_two = dt.datetime(2024, 3, 31)
    return {
        "load_bronze_full": timed(lambda: loads.load_bronze_full(store, first, LOADS[1], SOURCE_SYSTEM)),
        "load_silver_first": timed(lambda: loads.load_silver(store, LOADS[1])),
        "load_dimensions_first": timed(lambda: loads.load_dimensions(store)),
        "load_bronze_delta": timed(lambda: loads.load_bronze_delta(store, second, day_two, NOW, SOURCE_SYSTEM)),
        "load_silver_second": timed(lambda: loads.load_silver(store, NOW)),
        "load_dimensions_second": timed(lambda: loads.load_dimensions(store)),
        "load_facts": timed(lambda: loads.load_facts(store, NOW)),
    }


def comparison(spark: SparkSession) -> dict[str, dict[str, float]]:
    w = warehouse(spark, FOLDER)
    silver = w.silver()
    dimension = w.dimension("dim_customer")
    bronze = w.keep("bench_rental", lambda: w.bronze("rental", 2))
    window = (dt.datetime(2024, 3, 15), dt.datetime(2024, 3, 16))
    pairs: dict[str, tuple[Callable[[], DataFrame], Callable[[], DataFrame]]] = {
        "spine_customer_day": (
            lambda: spine(facts.customer_days(silver, NOW), DAY, "full_date"),
            lambda: textbook.customer_days_by_range_join(silver, NOW),
        ),
        "fact_customer_daily_activity": (
            lambda: facts.fact_customer_daily_activity(silver, dimension, NOW),
            lambda: textbook.customer_fact_by_joins(silver, dimension, NOW),
        ),
        "inventory_status_day": (
            lambda: facts.inventory_status(silver, NOW),
            lambda: textbook.inventory_status_by_exists(silver, NOW),
        ),
        "bronze_delta_rental": (
            lambda: bronze.where(changed_between(*window)),
            lambda: textbook.changed_by_greatest(bronze, *window),
        ),
    }
    found = {}
    for name, (ours, usual) in pairs.items():
        for form in (ours, usual):
            run(form())
        found[name] = {
            "library": min(timed(lambda: run(ours())) for _ in range(2)),
            "textbook": min(timed(lambda: run(usual())) for _ in range(2)),
        }
    return found


def main() -> None:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, lake = builders(), warehouse(spark, FOLDER)
    # The first pass writes the tables that queries read and warms up the JVM.
    for name in HEADLINE:
        run(queries[name](lake))
    # The better of two, as in the comparison.
    times = {
        name: min(timed(lambda n=name: run(queries[n](lake))) for _ in range(2)) for name in HEADLINE
    }
    times |= load_times(spark)
    result = {
        "metric": "warehouse_queries_and_loads_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    if "--compare" in sys.argv:
        result["comparison"] = comparison(spark)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
