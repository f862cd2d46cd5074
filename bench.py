"""Headline queries on local[BENCH_CPUS]; prints one JSON line with seconds per query.

``queries`` is the whole wall time of a query on a fresh DataFrame: building the plan in Python and
running it to the last row. ``building`` and ``running`` are its two parts. The settings are those of
`ledgermill.session.build_session` and the size of the machine.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import queries  # noqa: E402
from ledgermill.session import SETTINGS  # noqa: E402

HEADLINE = (
    "kpi_clean",
    "monthly_revenue_clean",
    "silver_customers",
    "silver_transactions",
    "revenue_by_plan_clean",
    "new_customers_clean",
    "stage_distribution_clean",
    "kpi_clean_filtered",
    "kpi_raw",
    "monthly_revenue_raw",
    "report_clean",
    "filter_options",
    "revenue_ladder",
    "duplicate_transactions",
    "duplicate_summary",
    "bronze_billing_validation",
    "dq_report",
)
WARM_UP_RUNS = 2
RUNS = 5


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgermill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()

    def run(name: str) -> tuple[float, float]:
        """Seconds to build a fresh plan, and to run it to the last row."""
        started = time.perf_counter()
        df = registered[name](spark, sf_dir)
        built = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return built - started, time.perf_counter() - built

    # All of them first: the JVM compiles what they share while the first ones run.
    for _ in range(WARM_UP_RUNS):
        for name in names:
            run(name)
    building, running, seconds = {}, {}, {}
    for name in names:
        built, ran = zip(*(run(name) for _ in range(RUNS)))
        building[name] = round(statistics.median(built), 3)
        running[name] = round(statistics.median(ran), 3)
        seconds[name] = round(statistics.median(b + r for b, r in zip(built, ran)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "building": building,
                "running": running,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
