"""Business reports over the gold star schema.

Each report first aggregates the fact by the dimension's surrogate key
(partial aggregation happens map-side, so a merchant or customer owning a
third of all facts becomes one row per map task), then joins that compact
table to the dimension and aggregates by the report's attributes.  Sums,
counts and distinct counts are exact under this rewrite: every surrogate key
belongs to exactly one dimension row.

Money leaves as exact DECIMAL sums; averages and rates are DECIMAL(22,2),
rounded HALF_UP on exact values (``paymart.functions.money``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.functions.money import pct_rate, round_avg
from paymart.operators.joins import checked_broadcast
from paymart.operators.quality import count_if


def _per_key(fact: DataFrame, key: str, **extra) -> DataFrame:
    return fact.groupBy(key).agg(
        F.count("transaction_id").alias("_n"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum("txn_amount").alias("_amt"),
        F.sum("platform_fee").alias("_fee"),
        *[v.alias(k) for k, v in extra.items()],
    )


def monthly_gmv(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Successful transactions per calendar month: count, GMV, fees, cashback, net, average."""
    pre = fact.filter(F.col("txn_status") == "SUCCESS").groupBy("date_key").agg(
        F.count("transaction_id").alias("_n"),
        F.sum("txn_amount").alias("_amt"),
        F.sum("platform_fee").alias("_fee"),
        F.sum("cashback_amount").alias("_cb"),
        F.sum("net_revenue").alias("_net"),
    )
    # The calendar holds at most 366 rows per covered year; its range comes
    # from the data, so it is broadcast behind the same size check.
    cal = checked_broadcast(dim_date.select("date_key", "year", "month", "month_name"))
    g = pre.join(cal, "date_key").groupBy("year", "month", "month_name").agg(
        F.sum("_n").cast("bigint").alias("total_transactions"),
        F.sum("_amt").alias("_amt"),
        F.sum("_fee").alias("_fee"),
        F.sum("_cb").alias("_cb"),
        F.sum("_net").alias("_net"),
    )
    return g.select(
        "year",
        "month_name",
        "month",
        "total_transactions",
        F.col("_amt").alias("gross_merchandise_value"),
        F.col("_fee").alias("total_platform_revenue"),
        F.col("_cb").alias("total_cashback"),
        F.col("_net").alias("net_revenue"),
        round_avg("_amt", "total_transactions").alias("avg_transaction_value"),
    ).orderBy("year", "month")


def top_merchants(fact: DataFrame, dim_merchant: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` (name, category, city) groups by platform-fee revenue.

    Merchants sharing name, category and city form one group.  Ties on
    revenue are broken by name, category and city so the cut at ``k`` is
    deterministic.
    """
    pre = _per_key(fact, "merchant_key", _failed=count_if(F.col("txn_status") == "FAILED"))
    m = dim_merchant.select("merchant_key", "merchant_name", "category", "city")
    g = pre.join(m, "merchant_key").groupBy("merchant_name", "category", "city").agg(
        F.sum("_n").cast("bigint").alias("total_transactions"),
        F.sum("_rows").alias("_rows"),
        F.sum("_amt").alias("_amt"),
        F.sum("_fee").alias("_fee"),
        F.sum("_failed").cast("bigint").alias("failed_transactions"),
    )
    return (
        g.orderBy(F.col("_fee").desc_nulls_last(), "merchant_name", "category", "city")
        .limit(k)
        .select(
            "merchant_name",
            "category",
            "city",
            "total_transactions",
            F.col("_amt").alias("total_gmv"),
            F.col("_fee").alias("total_revenue"),
            round_avg("_amt", "total_transactions").alias("avg_txn_value"),
            "failed_transactions",
            pct_rate("failed_transactions", "_rows").alias("failure_rate_pct"),
        )
    )


def payment_method_success(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Counts, success and failure, success rate, average amount and revenue per method."""
    pre = _per_key(
        fact,
        "payment_method_key",
        _ok=count_if(F.col("txn_status") == "SUCCESS"),
        _failed=count_if(F.col("txn_status") == "FAILED"),
    )
    p = dim_payment.select("payment_method_key", "method_name", "method_type")
    g = pre.join(p, "payment_method_key").groupBy("method_name", "method_type").agg(
        F.sum("_n").cast("bigint").alias("total_transactions"),
        F.sum("_rows").alias("_rows"),
        F.sum("_ok").cast("bigint").alias("successful_txns"),
        F.sum("_failed").cast("bigint").alias("failed_txns"),
        F.sum("_amt").alias("_amt"),
        F.sum("_fee").alias("_fee"),
    )
    return g.select(
        "method_name",
        "method_type",
        "total_transactions",
        "successful_txns",
        "failed_txns",
        pct_rate("successful_txns", "_rows").alias("success_rate_pct"),
        round_avg("_amt", "total_transactions").alias("avg_txn_amount"),
        F.col("_fee").alias("total_revenue"),
    ).orderBy(F.col("total_transactions").desc(), "method_name", "method_type")


def segment_revenue(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Per (segment, KYC tier) of *current* versions: customers, GMV, fraud.

    Only facts tied to a current version count (facts of expired versions are
    left out, as in the original report).
    """
    pre = _per_key(fact, "customer_key", _fraud=F.sum("is_fraud_flag"))
    c = dim_customer.filter(F.col("is_current") == 1).select("customer_key", "customer_segment", "kyc_tier")
    g = pre.join(c, "customer_key").groupBy("customer_segment", "kyc_tier").agg(
        # one pre-aggregated row per customer_key: counting rows counts distinct keys
        F.count(F.lit(1)).cast("bigint").alias("unique_customers"),
        F.sum("_n").cast("bigint").alias("total_transactions"),
        F.sum("_rows").alias("_rows"),
        F.sum("_amt").alias("_amt"),
        F.sum("_fee").alias("_fee"),
        F.sum("_fraud").cast("bigint").alias("fraud_transactions"),
    )
    return g.select(
        "customer_segment",
        "kyc_tier",
        "unique_customers",
        "total_transactions",
        F.col("_amt").alias("total_gmv"),
        F.col("_fee").alias("total_revenue"),
        round_avg("_amt", "total_transactions").alias("avg_txn_value"),
        round_avg("_amt", "unique_customers").alias("gmv_per_customer"),
        "fraud_transactions",
        pct_rate("fraud_transactions", "_rows").alias("fraud_rate_pct"),
    ).orderBy(F.col("total_revenue").desc_nulls_last(), "customer_segment", "kyc_tier")


def kyc_point_in_time(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Revenue by the KYC tier the customer had *when the transaction happened*."""
    pre = _per_key(fact, "customer_key")
    c = dim_customer.select("customer_key", "customer_id", "kyc_tier")
    g = pre.join(c, "customer_key").groupBy("kyc_tier").agg(
        F.sum("_n").cast("bigint").alias("total_transactions"),
        F.count_distinct("customer_id").cast("bigint").alias("unique_customers"),
        F.sum("_amt").alias("_amt"),
        F.sum("_fee").alias("_fee"),
    )
    return g.select(
        F.col("kyc_tier").alias("kyc_tier_at_time_of_txn"),
        "total_transactions",
        "unique_customers",
        F.col("_amt").alias("total_gmv"),
        F.col("_fee").alias("total_revenue"),
        round_avg("_amt", "total_transactions").alias("avg_txn_value"),
    ).orderBy(F.col("total_revenue").desc_nulls_last(), "kyc_tier_at_time_of_txn")


def version_split(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Transactions and GMV by (tier at transaction time, whether that version is current)."""
    pre = _per_key(fact, "customer_key")
    c = dim_customer.select("customer_key", "kyc_tier", "is_current")
    g = pre.join(c, "customer_key").groupBy("kyc_tier", "is_current").agg(
        F.sum("_n").cast("bigint").alias("transactions"),
        F.sum("_amt").alias("_amt"),
    )
    return g.select(
        F.col("kyc_tier").alias("kyc_tier_at_txn_time"),
        "is_current",
        "transactions",
        F.col("_amt").alias("gmv"),
    ).orderBy("kyc_tier_at_txn_time", "is_current")
