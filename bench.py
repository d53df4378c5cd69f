"""Benchmark: the warehouse pipeline and its reports at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line.

Timed, in a warm session:

* ``pipeline_end_to_end``: bronze ingest of the landed CSV files, silver,
  SCD1/SCD2 dimensions for two load days, calendar and the partitioned fact,
  every table written to storage (one run).  Producing the landed CSV files
  from the test tables (the feeds "arriving") is reported separately as
  ``landing`` and not counted, as the original pipeline starts from files;
* ``q1``..``q5b``: the six reports over the stored gold tables, as a BI user
  would run them (median of three runs each);
* ``fact_rebuild``: the fact rebuilt from stored silver and dimensions
  (median of three).

``value`` is the sum of the timed entries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paymart.plans import gold, pipeline, reports  # noqa: E402
from paymart.sources.fixtures import DAY2  # noqa: E402

REPORTS = {
    "q1_monthly_gmv": lambda g: reports.monthly_gmv(g["fact"], g["dim_date"]),
    "q2_top_merchants": lambda g: reports.top_merchants(g["fact"], g["dim_merchant"]),
    "q3_payment_methods": lambda g: reports.payment_method_success(g["fact"], g["dim_payment"]),
    "q4_segment_revenue": lambda g: reports.segment_revenue(g["fact"], g["dim_customer"]),
    "q5_kyc_point_in_time": lambda g: reports.kyc_point_in_time(g["fact"], g["dim_customer"]),
    "q5b_version_split": lambda g: reports.version_split(g["fact"], g["dim_customer"]),
}


def _session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("paymart-bench")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(cpus))))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def _median(fn, runs: int = 3) -> float:
    return statistics.median(_timed(fn) for _ in range(runs))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = _session(cpus)
    times: dict[str, float] = {}

    # Warm the JVM (class loading, codegen caches) on the smallest tables.
    warm_dir = "/root/testdata/sf0.001"
    if os.path.isdir(warm_dir):
        pipeline.run_pipeline(spark, warm_dir)

    holder = {}
    total_run = _timed(lambda: holder.update(lake=pipeline.run_pipeline(spark, sf_dir)))
    lake = holder["lake"]
    landing = sum(v for k, v in lake.seconds.items() if k.startswith("landing."))
    times["pipeline_end_to_end"] = total_run - landing
    g = {
        "fact": lake.read(spark, "gold.fact_transaction"),
        "dim_date": lake.read(spark, "gold.dim_date"),
        "dim_merchant": lake.read(spark, "gold.dim_merchant"),
        "dim_payment": lake.read(spark, "gold.dim_payment_method"),
        "dim_customer": lake.read(spark, "gold.dim_customer"),
    }
    for name, build in REPORTS.items():
        times[name] = _median(lambda b=build: b(g).collect())
    txn = lake.read(spark, "silver.transactions")
    times["fact_rebuild"] = _median(
        lambda: gold.fact_transaction(txn, g["dim_customer"], g["dim_merchant"], g["dim_payment"], DAY2)
        .write.format("noop").mode("overwrite").save()
    )
    total = sum(times.values())
    stages = {k: round(v, 3) for k, v in lake.seconds.items()}
    print(json.dumps({
        "metric": "pipeline_plus_reports_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": int(cpus),
        "landing": round(landing, 3),
        "pipeline_stages": stages,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
