"""Gold tables as temporary SQL views.

``register_views`` exposes the star schema under the usual names, so
ad-hoc Spark SQL (``spark.sql("SELECT ... FROM fact_transaction f JOIN
dim_date d ON ...")``) runs against the stored gold tables next to the
DataFrame reports of ``plans.reports``.  The views are lazy file relations:
filters and projections of each SQL statement are pushed into the parquet
scans as usual.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from paymart.plans.pipeline import Lakehouse

# view name -> lakehouse table
GOLD_VIEWS = {
    "fact_transaction": "gold.fact_transaction",
    "dim_customer": "gold.dim_customer",
    "dim_merchant": "gold.dim_merchant",
    "dim_payment_method": "gold.dim_payment_method",
    "dim_date": "gold.dim_date",
}


def register_frames(frames: Mapping[str, DataFrame]) -> list[str]:
    """Register each DataFrame as a temp view under its key; returns the names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)


def register_views(spark: SparkSession, lake: Lakehouse) -> list[str]:
    """Register the five gold tables of ``lake`` as temp views."""
    return register_frames({view: lake.read(spark, table) for view, table in GOLD_VIEWS.items()})
