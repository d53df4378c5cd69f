"""Command line: build the warehouse from a table directory and print the reports.

    python -m paymart pipeline --sf-dir /root/testdata/sf0.01 [--master local[8]]

Runs ``plans.pipeline.run_pipeline`` (tables under ``spark.checkpoint.dir``),
registers the gold views and shows every report.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from paymart.plans import pipeline, reports
from paymart.plans.views import register_views


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="paymart")
    ap.add_argument("command", choices=["pipeline"])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    args = ap.parse_args(argv)
    b = SparkSession.builder.appName("paymart")
    if args.master:
        b = b.master(args.master)
    spark = b.getOrCreate()
    lake = pipeline.run_pipeline(spark, args.sf_dir)
    print("tables:", {k: v for k, v in lake.rows.items()})
    register_views(spark, lake)
    fact, dc = lake.read(spark, "gold.fact_transaction"), lake.read(spark, "gold.dim_customer")
    shows = {
        "monthly GMV": reports.monthly_gmv(fact, lake.read(spark, "gold.dim_date")),
        "top merchants": reports.top_merchants(fact, lake.read(spark, "gold.dim_merchant")),
        "payment methods": reports.payment_method_success(fact, lake.read(spark, "gold.dim_payment_method")),
        "segments (current versions)": reports.segment_revenue(fact, dc),
        "KYC tier at transaction time": reports.kyc_point_in_time(fact, dc),
        "current vs historical versions": reports.version_split(fact, dc),
    }
    for title, df in shows.items():
        print(f"\n== {title}")
        df.show(max(1, df.count()), truncate=False)  # a report, all its rows


if __name__ == "__main__":
    main()
