"""Times the headline queries and prints one line of JSON.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of threads.
``prepare`` is the time to land the values and to build the registries, the cleaned
values and the fact that the reports read; no query is timed twice or warmed up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shipments import model  # noqa: E402
from shipments.catalog import QUERIES  # noqa: E402

HEADLINE = """
    quarantine_rate resolve_units dedup_latest value_flags late_flag iqr_outlier outlier_limits
    completeness dq_tally fact_build contract_fact new_period_rows sink_fact
    monthly_volume kpi_summary period_change rolling_avg reporting_rate underreporters
    country_kpis quarterly_volumes coverage_matrix completeness_by_country low_streaks global_totals
    anomalies event_anomalies drift_report run_summary
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reportmart-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    times: dict[str, float] = {}
    started = time.perf_counter()
    model.fact_table(spark, sf_dir)
    times["prepare"] = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
