"""Time the headline queries; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from wardmill.catalog import registry

QUERIES = [
    "month_end_snapshot",
    "order_ordinals",
    "event_run_start",
    "purchase_as_of_view",
    "orders_within_half_year",
    "shipments_inside_order_windows",
    "overlapping_order_pairs",
    "order_days_by_month",
    "event_pivot",
    "daily_quantity_summary",
    "merged_customer_rows",
    "top_three_brands_per_order",
    "members_of_regions",
    "monthly_skeleton_kpis",
    "incremental_refresh_orders",
    "extract_all_vitals",
    "extract_all_encounters",
    "derive_all_admissions",
    "derive_inpatient_census",
    "derive_hiv_monthly_reporting",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardmill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    reg = registry()
    spark.read.parquet(f"{folder}/orders.parquet").count()
    times = {}
    for name in QUERIES:
        t0 = time.perf_counter()
        reg[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
