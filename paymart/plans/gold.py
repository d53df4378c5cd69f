"""Gold layer: dimensions and the transaction fact.

Fact build: silver transactions get an integer ``date_key``, then the merchant
and payment-method surrogate keys (equi lookups) and the customer version valid
on the transaction date (as-of join).  Each join broadcasts its dimension behind
a size check, or else shuffles with hot and missing keys spread.  No join can
multiply fact rows: merchants are unique on their id, payment methods are
reduced to one per code, and customer versions do not overlap; ``fact_quality``
checks the grain.

The calendar join of the original design only re-attached ``date_key`` (a
no-op that still costs a join); membership in the calendar is reported by
``fact_quality`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.functions.dates import date_key
from paymart.operators.joins import (
    DEFAULT_HOT_KEY_ROWS,
    DEFAULT_MAX_BROADCAST_ROWS,
    DEFAULT_MAX_HOT_KEYS,
    DEFAULT_SALT_BUCKETS,
    as_of_join,
    fits,
    hot_keys,
    lookup_join,
)
from paymart.operators.quality import count_if
from paymart.operators.scd1 import scd1_initial, scd1_merge
from paymart.operators.scd2 import scd2_initial, scd2_merge, scd2_step
from paymart.schemas import (
    CUSTOMER_TRACKED,
    DIM_CUSTOMER_COLUMNS,
    DIM_MERCHANT_COLUMNS,
    DIM_PAYMENT_COLUMNS,
    FACT_COLUMNS,
    MERCHANT_TRACKED,
    PAYMENT_TRACKED,
)
from paymart.sources.bronze import load_stamp

# name -> (natural key, surrogate key, tracked attributes, image columns)
DIMENSIONS = {
    "merchant": ("merchant_id", "merchant_key", MERCHANT_TRACKED, DIM_MERCHANT_COLUMNS),
    "payment_method": ("method_id", "payment_method_key", PAYMENT_TRACKED, DIM_PAYMENT_COLUMNS),
    "customer": ("customer_id", "customer_key", CUSTOMER_TRACKED, DIM_CUSTOMER_COLUMNS),
}


def load_type1(
    name: str, old: DataFrame | None, silver: DataFrame, as_of: str, stage=None, null_safe: bool = False,
    offset: int | None = None, rows_known: int | None = None,
) -> DataFrame:
    """Initial load when there is no image yet, else an SCD1 merge (``stage``, ``offset``, ``rows_known``: see ``scd1_merge``)."""
    nk, key, tracked, cols = DIMENSIONS[name]
    if old is None:
        return scd1_initial(silver, nk, key, tracked, cols, as_of, null_safe, offset, rows_known)
    return scd1_merge(old, silver, nk, key, tracked, cols, as_of, stage, null_safe, offset, rows_known)


def load_customers(
    old: DataFrame | None, silver: DataFrame, as_of: str, initial_start: str = "created_date", stage=None, null_safe: bool = False
) -> DataFrame:
    """Initial load when there is no image yet, else an SCD2 merge (``stage``: see ``scd2_step``)."""
    nk, key, tracked, cols = DIMENSIONS["customer"]
    if old is None:
        return scd2_initial(silver, nk, key, tracked, cols, as_of, initial_start, null_safe)
    return scd2_merge(old, silver, nk, key, tracked, cols, as_of, initial_start, stage, null_safe)


def step_customers(
    current: DataFrame | None, silver: DataFrame, as_of: str, initial_start: str = "created_date", stage=None, null_safe: bool = False,
    offset: int | None = None, rows_known: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(next current versions, versions closed by this load) of the customer dimension; without an image, the first one."""
    nk, key, tracked, cols = DIMENSIONS["customer"]
    if current is None:
        first = scd2_initial(silver, nk, key, tracked, cols, as_of, initial_start, null_safe, offset, rows_known)
        return first, first.limit(0)
    return scd2_step(current, silver, nk, key, tracked, cols, as_of, initial_start, stage, null_safe, offset, rows_known)


def with_date_key(txn: DataFrame) -> DataFrame:
    return txn.withColumn("date_key", date_key("txn_date"))


def payment_lookup(dim_payment: DataFrame) -> DataFrame:
    """(method_code, payment_method_key), one row per code.

    The dimension is unique on ``method_id``; of methods that share a code the
    one of smallest id is looked up.  ``payment_code_conflicts`` counts them.
    """
    first = F.min(F.struct("method_id", "payment_method_key"))
    coded = dim_payment.where(F.col("method_code").isNotNull())
    return coded.groupBy("method_code").agg(first.alias("_m")).select("method_code", F.col("_m.payment_method_key").alias("payment_method_key"))


def payment_code_conflicts(dim_payment: DataFrame) -> DataFrame:
    """(method_code, methods) of the codes that several methods share."""
    coded = dim_payment.where(F.col("method_code").isNotNull())
    return coded.groupBy("method_code").agg(F.count(F.lit(1)).cast("bigint").alias("methods")).where("methods > 1")


def _versions(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select("customer_id", "customer_key", "effective_start", "effective_end")


def customer_keys(
    txn: DataFrame, dim_customer: DataFrame, feed: DataFrame, hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    salt_buckets: int = DEFAULT_SALT_BUCKETS, max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
) -> DataFrame:
    """``txn``, whose ids are distinct, with the key of the customer version valid on its date, by the shuffle join of ``fact_transaction``.

    For customers that outgrow a broadcast: only id, customer and date of a row go to its customer, and id and key
    come back.  Rows that are dealt by id already (deduplicated ones) stay where they are.  Hot customers are
    counted on ``feed``, the rows that ``txn`` is made of.
    """
    hot = hot_keys(feed, "customer_id", hot_key_rows, max_hot_keys)
    asked = txn.select("transaction_id", "customer_id", "txn_date").where(F.col("customer_id").isNotNull() & F.col("txn_date").isNotNull())
    found = as_of_join(asked, _versions(dim_customer), key="customer_id", at="txn_date", how="inner", small=False, hot=hot, salt_buckets=salt_buckets)
    keys = found.select(F.col("transaction_id").alias("_id"), "customer_key").hint("merge")
    return txn.join(keys, F.col("transaction_id") == F.col("_id"), "left").drop("_id")


def fact_transaction(
    txn: DataFrame,
    dim_customer: DataFrame,
    dim_merchant: DataFrame,
    dim_payment: DataFrame,
    as_of: str,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
    max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
    small: dict[str, bool] | None = None,
) -> DataFrame:
    """Hot merchants and customers are counted on ``txn`` itself, before any join, and only if a join has to shuffle.

    ``small``: by join key, whether the dimension may be broadcast, if the caller knows its size.
    A ``txn`` with a column ``customer_key`` has its customers already (``customer_keys``).
    """
    merchants = dim_merchant.select("merchant_id", "merchant_key")
    payments = payment_lookup(dim_payment)
    lookups = [(merchants, "merchant_id"), (payments, "method_code")]
    if "customer_key" not in txn.columns:
        lookups.append((_versions(dim_customer), "customer_id"))
    steps = {}
    for dim, key in lookups:
        few = fits(dim, max_broadcast_rows) if small is None else small[key]
        steps[key] = {"small": few, "hot": None if few else hot_keys(txn, key, hot_key_rows, max_hot_keys), "salt_buckets": salt_buckets}
    t = lookup_join(txn, merchants, "merchant_id", **steps["merchant_id"])
    t = lookup_join(t, payments, "method_code", **steps["method_code"])
    if "customer_id" in steps:
        t = as_of_join(t, _versions(dim_customer), key="customer_id", at="txn_date", **steps["customer_id"])
    # derived after the joins, so a shuffle does not carry it
    return with_date_key(t).withColumn("created_at", F.lit(load_stamp(as_of))).select(*FACT_COLUMNS)


def fact_metrics(in_calendar: Column) -> dict[str, Column]:
    """The counts of ``fact_quality`` that need no shuffle; ``in_calendar``: whether the calendar has the fact's date."""
    missing = {f"null_{k}": count_if(F.col(k).isNull()) for k in ("customer_key", "merchant_key", "payment_method_key", "date_key")}
    outside = F.col("date_key").isNotNull() & ~F.coalesce(in_calendar, F.lit(False))
    return {"total_rows": F.count(F.lit(1)).cast("bigint"), **missing, "date_key_not_in_calendar": count_if(outside)}


def fact_quality(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One-pass profile: NULL keys, calendar misses and the fact grain.

    The calendar (at most 366 rows per covered year) is broadcast behind the
    size check.
    """
    cal = dim_date.select("date_key", F.lit(True).alias("_in_calendar"))
    counts = [c.alias(n) for n, c in fact_metrics(F.col("_in_calendar")).items()]
    return lookup_join(fact, cal, "date_key").agg(*counts, F.count_distinct("transaction_id").cast("bigint").alias("distinct_transactions"))
