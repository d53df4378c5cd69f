"""Report states kept by load day, and the reports merged from them.

A day's facts are read once, when they are written, and leave two small tables:

* ``customer_spend``: sums per customer version (surrogate key).  States of several
  days merge by addition.  Whether a version is current is looked up when states are
  merged, so a version that a later day closes leaves the segment report, and its
  amounts with it, without touching the stored states;
* ``tier_bitmaps``: per KYC tier at the time of the transaction, the customers seen,
  one bit each, in bitmaps of 32,768 members.  They merge by OR, so a distinct count
  over any set of days moves bitmaps and never customer ids.  A customer's bit is
  the key of the oldest stored version, dense by construction.

A day whose facts are written again (late days, late dimension rows) gets its
states anew with them; states of other days stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.functions.money import pct_rate, round_avg
from paymart.operators.quality import count_if

SUMS = ("transactions", "fact_rows", "amount", "fee", "fraud", "successful", "failed")


def customer_spend(fact: DataFrame) -> DataFrame:
    """One row per customer key of ``fact``; facts without a key count in no customer report and are left out."""
    return fact.where(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(
        F.count("transaction_id").alias("transactions"),
        F.count(F.lit(1)).alias("fact_rows"),
        F.sum("txn_amount").alias("amount"),
        F.sum("platform_fee").alias("fee"),
        F.sum("is_fraud_flag").alias("fraud"),
        count_if(F.col("txn_status") == "SUCCESS").alias("successful"),
        count_if(F.col("txn_status") == "FAILED").alias("failed"),
    )


def tier_bitmaps(spend: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """(kyc_tier, bucket, members) of the customers in ``spend``."""
    oldest = dim_customer.groupBy("customer_id").agg(F.min("customer_key").alias("member"))
    tiers = dim_customer.select("customer_key", "customer_id", "kyc_tier")
    seen = spend.select("customer_key").join(tiers, "customer_key").join(oldest, "customer_id")
    bucket, bit = F.bitmap_bucket_number("member"), F.bitmap_bit_position("member")
    return seen.groupBy("kyc_tier", bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("members"))


def distinct_members(bitmaps: DataFrame, by: str = "kyc_tier") -> DataFrame:
    """(``by``, members): exact distinct counts of the bitmaps of any days."""
    merged = bitmaps.groupBy(by, "bucket").agg(F.bitmap_or_agg("members").alias("members"))
    return merged.groupBy(by).agg(F.sum(F.bitmap_count("members")).cast("bigint").alias("members"))


def _total(spend: DataFrame) -> DataFrame:
    """States of several days as one row per customer key."""
    return spend.groupBy("customer_key").agg(*[F.sum(c).alias(c) for c in SUMS])


def segment_revenue(spend: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """``reports.segment_revenue`` from the states of all days."""
    current = dim_customer.where(F.col("is_current") == 1).select("customer_key", "customer_segment", "kyc_tier")
    g = _total(spend).join(current, "customer_key").groupBy("customer_segment", "kyc_tier").agg(
        F.count(F.lit(1)).cast("bigint").alias("unique_customers"),
        F.sum("transactions").cast("bigint").alias("total_transactions"),
        F.sum("fact_rows").alias("_rows"),
        F.sum("amount").alias("total_gmv"),
        F.sum("fee").alias("total_revenue"),
        F.sum("fraud").cast("bigint").alias("fraud_transactions"),
    )
    return g.select(
        "customer_segment", "kyc_tier", "unique_customers", "total_transactions", "total_gmv", "total_revenue",
        round_avg("total_gmv", "total_transactions").alias("avg_txn_value"),
        round_avg("total_gmv", "unique_customers").alias("gmv_per_customer"),
        "fraud_transactions",
        pct_rate("fraud_transactions", "_rows").alias("fraud_rate_pct"),
    ).orderBy(F.col("total_revenue").desc_nulls_last(), "customer_segment", "kyc_tier")


def kyc_point_in_time(spend: DataFrame, bitmaps: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """``reports.kyc_point_in_time`` from the states of all days; customers are counted by their bitmaps."""
    tiers = dim_customer.select("customer_key", "kyc_tier")
    g = _total(spend).join(tiers, "customer_key").groupBy("kyc_tier").agg(
        F.sum("transactions").cast("bigint").alias("total_transactions"),
        F.sum("amount").alias("total_gmv"),
        F.sum("fee").alias("total_revenue"),
    )
    counts = distinct_members(bitmaps).select(F.col("kyc_tier").alias("_tier"), F.col("members").alias("unique_customers"))
    return g.join(counts, F.col("kyc_tier").eqNullSafe(F.col("_tier"))).select(
        F.col("kyc_tier").alias("kyc_tier_at_time_of_txn"), "total_transactions", "unique_customers", "total_gmv", "total_revenue",
        round_avg("total_gmv", "total_transactions").alias("avg_txn_value"),
    ).orderBy(F.col("total_revenue").desc_nulls_last(), "kyc_tier_at_time_of_txn")
