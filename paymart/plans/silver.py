"""Silver layer: typed, cleaned, validated and deduplicated tables.

Each transform takes the bronze rows of one source (raw strings plus audit
columns) and the load day ``as_of``; it returns a lazy DataFrame.  All steps
are narrow projections and filters that stay inside one codegen stage, except
the deduplication, which is the only shuffle (on the natural key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paymart.functions.casts import to_date, to_decimal, to_int
from paymart.functions.clean import initcap_trim, lower_trim, trim, upper_trim
from paymart.operators.dedupe import dedupe_latest, total_order
from paymart.operators.quality import VALID_STATUSES, count_if, drop_null_keys, is_valid_transaction
from paymart.schemas import AUDIT_COLUMNS, RAW_COLUMNS, SILVER_COLUMNS
from paymart.sources.bronze import load_stamp

# NULL replacements of the silver layer.
UNKNOWN = "UNKNOWN"
MEASURES = ["txn_amount", "platform_fee", "cashback_amount"]


def _stamp(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumn("silver_loaded_at", F.lit(load_stamp(as_of)))


def fill_with(c: str, value, dtype: str) -> Column:
    """coalesce(c, value) keeping the column's type (decimals stay decimals)."""
    return F.coalesce(F.col(c), F.lit(value).cast(dtype)).alias(c)


# ---- customers ---------------------------------------------------------------

def typed_customers(bronze: DataFrame) -> DataFrame:
    """Casts and string cleaning (before NULL defaults)."""
    return bronze.withColumns(
        {
            "wallet_limit": to_int("wallet_limit"),
            "created_date": to_date("created_date"),
            "is_active": F.lit(1),
            "full_name": trim("full_name"),
            "email": lower_trim("email"),
            "city": initcap_trim("city"),
            "state": upper_trim("state"),
            "kyc_tier": upper_trim("kyc_tier"),
            "customer_segment": upper_trim("customer_segment"),
        }
    )


def fill_customer_defaults(df: DataFrame) -> DataFrame:
    return df.fillna({"city": UNKNOWN, "state": UNKNOWN, "customer_segment": UNKNOWN})


def silver_customers(bronze: DataFrame, as_of: str) -> DataFrame:
    df = fill_customer_defaults(typed_customers(bronze))
    df = drop_null_keys(df, ["customer_id"])
    df = dedupe_latest(df, ["customer_id"])
    return _stamp(df, as_of).select(*SILVER_COLUMNS["customers"])


# ---- merchants ---------------------------------------------------------------

def typed_merchants(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "is_active": to_int("is_active"),
            "onboarded_date": to_date("onboarded_date"),
            "merchant_name": trim("merchant_name"),
            "category": upper_trim("category"),
            "sub_category": upper_trim("sub_category"),
            "city": initcap_trim("city"),
            "state": upper_trim("state"),
        }
    )


def fill_merchant_defaults(df: DataFrame) -> DataFrame:
    return df.fillna({"city": UNKNOWN, "state": UNKNOWN}).withColumn(
        "is_active", F.coalesce(F.col("is_active"), F.lit(1))
    )


def silver_merchants(bronze: DataFrame, as_of: str) -> DataFrame:
    df = fill_merchant_defaults(typed_merchants(bronze))
    df = drop_null_keys(df, ["merchant_id"])
    df = dedupe_latest(df, ["merchant_id"])
    return _stamp(df, as_of).select(*SILVER_COLUMNS["merchants"])


# ---- payment methods ---------------------------------------------------------

def typed_payment_methods(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "is_active": to_int("is_active"),
            "method_code": upper_trim("method_code"),
            "method_name": trim("method_name"),
            "method_type": upper_trim("method_type"),
        }
    )


def silver_payment_methods(bronze: DataFrame, as_of: str) -> DataFrame:
    """No NULL defaults here: an unknown ``is_active`` stays NULL."""
    df = drop_null_keys(typed_payment_methods(bronze), ["method_id"])
    df = dedupe_latest(df, ["method_id"])
    return _stamp(df, as_of).select(*SILVER_COLUMNS["payment_methods"])


# ---- transactions ------------------------------------------------------------

def typed_transactions(bronze: DataFrame) -> DataFrame:
    """Casts and cleaning; measures may still be NULL here."""
    return bronze.withColumns(
        {
            "txn_amount": to_decimal("txn_amount"),
            "platform_fee": to_decimal("platform_fee"),
            "cashback_amount": to_decimal("cashback_amount"),
            "is_fraud_flag": to_int("is_fraud_flag"),
            "txn_date": to_date("txn_date"),
            "txn_status": upper_trim("txn_status"),
            "method_code": upper_trim("method_code"),
            "failure_reason": upper_trim("failure_reason"),
        }
    )


def fill_transaction_defaults(df: DataFrame) -> DataFrame:
    """Missing or unparsable measures become 0.00 (still DECIMAL(10,2)), flags 0."""
    return df.withColumns(
        {
            **{m: F.coalesce(F.col(m), F.lit(0).cast("decimal(10,2)")) for m in MEASURES},
            "is_fraud_flag": F.coalesce(F.col("is_fraud_flag"), F.lit(0)),
        }
    )


def net_revenue(df: DataFrame) -> DataFrame:
    """``platform_fee - cashback_amount`` (DECIMAL(11,2)) plus year/month partition columns."""
    return df.withColumns(
        {
            "net_revenue": F.col("platform_fee") - F.col("cashback_amount"),
            "txn_year": F.year("txn_date"),
            "txn_month": F.month("txn_date"),
        }
    )


# Survivor of duplicate transaction ids: latest date, then largest amount, then
# the other business columns ascending (NULLs last in every position).  Derived
# columns and the constants of a load day decide nothing and are added after.
TXN_DEDUPE_FIRST = ["txn_date", "txn_amount"]


def dedupe_transactions(df: DataFrame, last: tuple[Column, ...] = ()) -> DataFrame:
    """``last``: what decides between rows that are equal in every business column."""
    business = df.select(*RAW_COLUMNS["transactions"])
    return dedupe_latest(df, ["transaction_id"], [*total_order(business, ["transaction_id"], TXN_DEDUPE_FIRST), *last])


def _filled_transactions(bronze: DataFrame) -> DataFrame:
    typed = typed_transactions(bronze).withColumn("_amount_defaulted", F.col("txn_amount").isNull())
    return fill_transaction_defaults(typed)


def _usual_audit(as_of: str) -> dict[str, str]:
    """The audit columns as a batch ingest of the load day writes them."""
    return {"load_timestamp": load_stamp(as_of), "source_file": "transactions.csv", "load_date": as_of}


def deduped_transactions(bronze: DataFrame, as_of: str, rejects: Observation | None = None) -> DataFrame:
    """The rows of ``silver_transactions`` as they are shuffled: business columns and ``_audit``, which is NULL unless a row's audit columns are others than usual."""
    df = _filled_transactions(bronze)
    if rejects is not None:
        df = df.observe(rejects, *[c.alias(n) for n, c in reject_metrics().items()])
    usual = [F.col(c).eqNullSafe(F.lit(v)) for c, v in _usual_audit(as_of).items()]
    audit = F.when(~(usual[0] & usual[1] & usual[2]), F.struct(*AUDIT_COLUMNS)).alias("_audit")
    # ordered by all that is shuffled, and without NULL ids by a filter that joins see, so that a step which needs few columns shares the shuffle
    rows = _valid(df).where(F.col("transaction_id").isNotNull()).select(*RAW_COLUMNS["transactions"], audit)
    return dedupe_transactions(rows, (F.col("_audit").asc_nulls_first(),))


def finished_transactions(deduped: DataFrame, as_of: str) -> DataFrame:
    """``deduped_transactions`` with everything that follows from their columns and the load day; further columns stay, last."""
    audit = {c: F.when(F.col("_audit").isNull(), F.lit(v)).otherwise(F.col("_audit")[c]) for c, v in _usual_audit(as_of).items()}
    further = [c for c in deduped.columns if c not in (*RAW_COLUMNS["transactions"], "_audit")]
    return _stamp(net_revenue(deduped.withColumns(audit)), as_of).select(*SILVER_COLUMNS["transactions"], *further)


def silver_transactions(bronze: DataFrame, as_of: str, rejects: Observation | None = None) -> DataFrame:
    """``rejects``: takes the counts of ``reject_metrics`` while the frame is computed."""
    return finished_transactions(deduped_transactions(bronze, as_of, rejects), as_of)


def _valid(filled: DataFrame) -> DataFrame:
    return drop_null_keys(filled, ["transaction_id", "customer_id", "merchant_id"]).filter(is_valid_transaction())


def transaction_ids(bronze: DataFrame) -> DataFrame:
    """The ids of ``silver_transactions``, each as often as valid rows have it (a narrow scan without a shuffle)."""
    return _valid(_filled_transactions(bronze)).select("transaction_id")


def _reject_classes() -> dict[str, Column]:
    null_key = F.col("transaction_id").isNull() | F.col("customer_id").isNull() | F.col("merchant_id").isNull()
    negative = ~null_key & (F.col("txn_amount") < 0)
    bad_status = ~null_key & ~negative & ~F.coalesce(F.col("txn_status").isin(*VALID_STATUSES), F.lit(False))
    return {
        "null_key_rejects": null_key, "negative_amount_rejects": negative, "invalid_status_rejects": bad_status,
        "rows_valid": ~null_key & ~negative & ~bad_status, "amount_defaulted": F.col("_amount_defaulted"),
    }


def reject_metrics() -> dict[str, Column]:
    """The counts of the transaction rules that need no shuffle, over rows as ``silver_transactions`` reads them."""
    return {"rows_in": F.count(F.lit(1)).cast("bigint"), **{name: count_if(c) for name, c in _reject_classes().items()}}


def transaction_rejects(bronze: DataFrame) -> DataFrame:
    """One-pass reject profile of the transaction rules, in rule order.

    A row is counted under the first rule that rejects it.  ``amount_defaulted``
    counts rows whose amount was missing or unparsable and became 0.00; such
    rows are kept, as the rules accept a 0.00 amount.
    """
    counts = {n: c.alias(n) for n, c in reject_metrics().items()}
    last = counts.pop("amount_defaulted")
    ids = F.count_distinct(F.when(_reject_classes()["rows_valid"], F.col("transaction_id"))).cast("bigint").alias("distinct_valid_ids")
    return _filled_transactions(bronze).agg(*counts.values(), ids, last)


def key_rejects(bronze: DataFrame, table: str, key: str) -> DataFrame:
    """One-row profile of a dimension feed: rows in, NULL keys, duplicate keys, rows kept."""
    return bronze.agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).cast("bigint").alias("rows_in"),
        count_if(F.col(key).isNull()).alias("null_key_rejects"),
        (F.count(F.col(key)) - F.count_distinct(F.col(key))).cast("bigint").alias("duplicate_rejects"),
        F.count_distinct(F.col(key)).cast("bigint").alias("rows_out"),
    )


# ---- customer updates (update-only merge) -------------------------------------

def typed_customer_updates(raw: DataFrame) -> DataFrame:
    """Casts and cleaning of the updates feed (no NULL defaults)."""
    return raw.withColumns(
        {
            "wallet_limit": to_int("wallet_limit"),
            "created_date": to_date("created_date"),
            "updated_date": to_date("updated_date"),
            "kyc_tier": upper_trim("kyc_tier"),
            "customer_segment": upper_trim("customer_segment"),
            "city": initcap_trim("city"),
            "state": upper_trim("state"),
        }
    )


# What an update may change.
UPDATE_COLUMNS = ["kyc_tier", "wallet_limit", "customer_segment", "city", "state"]


def update_matches(customers: DataFrame, updates_raw: DataFrame) -> DataFrame:
    """How the updates feed meets the customers: rows, distinct ids, matched, unmatched.

    ``matched_customers`` is the number of customers the merge changes (the
    original job reported the feed size instead).
    """
    upd = updates_raw.filter(F.col("customer_id").isNotNull()).select("customer_id")
    per_id = upd.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
    hit = per_id.join(customers.select("customer_id", F.lit(True).alias("_hit")), "customer_id", "left")
    return hit.agg(
        F.sum("_n").cast("bigint").alias("update_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_ids"),
        count_if(F.col("_hit").isNotNull()).alias("matched_customers"),
        count_if(F.col("_hit").isNull()).alias("unmatched_ids"),
        count_if(F.col("_n") > 1).alias("ids_with_several_updates"),
    )


def apply_customer_updates(
    customers: DataFrame,
    updates_raw: DataFrame,
    as_of: str,
    on_duplicate: str = "error",
) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE on ``customer_id``; unmatched updates are ignored.

    Matched rows take tier, wallet limit, segment, city, state and the load
    stamp from the update.  A customer with several updates is an error
    (``on_duplicate="error"``, raised lazily inside the job) or resolved to
    the latest ``updated_date`` (``"latest"``).
    """
    upd = typed_customer_updates(updates_raw).filter(F.col("customer_id").isNotNull())
    if on_duplicate == "latest":
        upd = dedupe_latest(upd, ["customer_id"], total_order(upd, ["customer_id"], ["updated_date"]))
    elif on_duplicate == "error":
        # Counted map-side per id, so a repeated id is one row per task; the check is
        # folded into the join key, where the optimizer cannot prune it.
        per_id = upd.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*UPDATE_COLUMNS)).alias("_u"))
        several = F.raise_error(F.concat(F.lit("several updates for customer "), F.col("customer_id")))
        upd = per_id.select(F.when(F.col("_n") > 1, several).otherwise(F.col("customer_id")).alias("customer_id"), "_u.*")
    else:
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    u = upd.select(
        F.col("customer_id").alias("_u_id"),
        *[F.col(c).alias(f"_u_{c}") for c in UPDATE_COLUMNS],
    )
    j = customers.join(u, F.col("customer_id") == F.col("_u_id"), "left")
    matched = F.col("_u_id").isNotNull()
    out = [
        (F.when(matched, F.col(f"_u_{c}")).otherwise(F.col(c)) if c in UPDATE_COLUMNS else F.col(c)).alias(c)
        for c in customers.columns
        if c != "silver_loaded_at"
    ]
    stamp = F.when(matched, F.lit(load_stamp(as_of))).otherwise(F.col("silver_loaded_at")).alias("silver_loaded_at")
    return j.select(*out, stamp).select(*customers.columns)
