"""Times the headline jobs and prints one JSON line.

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (local threads), BENCH_RUNS (timed runs after
one warm-up), BENCH_ONLY (comma-separated names).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from ledgerloom.operators import cleaning, core
from ledgerloom.plans import catalog
from ledgerloom.plans.warehouse import Warehouse, warehouse
from ledgerloom.schema import CORE_TABLES
from ledgerloom.session import build_session

# Registered queries that answer from staged core tables and marts.
QUERIES = [
    "m02_daily_sales", "m03_customer_daily", "m04_customer_snapshot", "f01_customer_features",
    "d03_sales_kpis", "d05_sales_by_country", "d07_customer_kpis", "d11_rfm_segments", "d16_segment_summary",
    "e05_product_popularity", "e10_sparsity_and_long_tail", "x07_repeat_purchase_rate", "a12_issue_table",
    "q29_financial_invoice_ledger", "q43_records",
]


def run_noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    started = time.perf_counter()
    house: Warehouse = warehouse(spark, folder)
    for table in [*CORE_TABLES, "mart_daily_sales", "mart_customer_daily", "mart_customer_snapshot"]:
        house.table(table)
    staging = time.perf_counter() - started

    registered = catalog.queries()

    def written(df, name):
        df.write.mode("overwrite").parquet(f"{house.root}/bench/{name}")

    def clean_pipeline():
        written(cleaning.clean_ledger(house.raw()), "clean")

    def core_load():
        for name, frame in core.build_core(house.clean(), house.source_system, house.fingerprint()).items():
            written(frame, name)

    def validation_suite():
        registered["q54_run_suite"](spark, folder).collect()

    work = {name: lambda name=name: run_noop(registered[name](spark, folder)) for name in QUERIES}
    work.update({"clean_pipeline": clean_pipeline, "core_load": core_load, "validation_suite": validation_suite})

    timings = {}
    for name, job in work.items():
        if only and name not in only:
            continue
        samples = []
        for attempt in range(runs + 1):
            started = time.perf_counter()
            job()
            if attempt:
                samples.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(samples), 3)
    timings["staging_from_raw_tables_cold"] = round(staging, 3)

    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds, warm, and of cold staging",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder).removeprefix("sf"),
                "ledger_lines": house.table("invoice_lines").count(),
                "cpus": cpus,
            }
        )
    )
    house.close()
    spark.stop()


if __name__ == "__main__":
    main()
