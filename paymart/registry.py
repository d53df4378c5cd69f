"""Every operator and report as a query over a test-table directory.

``queries()`` maps a name to ``f(spark, sf_dir) -> DataFrame``.  Each query
builds the two-day warehouse lazily from the tables in ``sf_dir``
(``plans.scenario``) and returns the frame of one operator, so its work grows
with the tables.  Queries of a single operator read whole tables (snapshot 0);
those of the merges and the pipeline read two differing snapshots, which is what
they are about.  Money leaves as DOUBLE here (exact decimals converted once) so
that results compare across engines; the library itself keeps DECIMAL.  A few
queries write tables (CSV landing, bronze, partitioned fact, the whole pipeline)
under the shared storage root and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from paymart.functions.casts import to_date, to_decimal, to_int
from paymart.functions.clean import initcap_trim, lower_trim, trim, upper_trim
from paymart.functions.dates import date_key
from paymart.functions.hashing import record_hash
from paymart.operators import scd2 as scd2_ops
from paymart.operators.calendar import dim_date
from paymart.operators.joins import as_of_join, lookup_join
from paymart.operators.keys import dense_keys
from paymart.operators.ordered import as_of_join_ordered, interval_audit
from paymart.operators.quality import drop_null_keys, valid_transactions
from paymart.plans import gold, pipeline, reports, silver, states
from paymart.plans.scenario import Warehouse
from paymart.plans.views import register_views
from paymart.schemas import CUSTOMER_TRACKED, DIM_CUSTOMER_COLUMNS, FACT_COLUMNS, MERCHANT_TRACKED
from paymart.sources import fixtures
from paymart.sources.bronze import add_audit_columns, ingest_csv, read_bronze, read_quarantine
from paymart.sources.csv import read_csv_strings, write_csv
from paymart.sources.fixtures import DAY1, DAY2, DAY3
from paymart.sources.storage import new_table_path, read_table, write_table
from paymart.streaming.landing import stream_landing_to_bronze

Query = Callable[[SparkSession, str], DataFrame]


def as_doubles(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE (exact for DECIMAL(p<=15, 2) values)."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
          for f in df.schema.fields]
    )


_SHARED: dict[tuple[str, str], Warehouse] = {}


def _w(spark: SparkSession, sf_dir: str, **opts) -> Warehouse:
    """The scenario for ``sf_dir``, shared by all default-option queries of a session.

    Its staged frames (dimension images, silver customer snapshots) are then
    built and written once per session instead of once per query.  A new session (new application id) gets a fresh scenario.
    """
    if opts:
        return Warehouse(spark, sf_dir, **opts)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _SHARED:
        _SHARED[key] = Warehouse(spark, sf_dir)
    return _SHARED[key]


_CUST_ARGS = ("customer_id", "customer_key", CUSTOMER_TRACKED, DIM_CUSTOMER_COLUMNS)


# ---- sources -------------------------------------------------------------------

def q_bronze_ingest(spark, sf_dir):
    """Land transactions as CSV, scan them back as strings, add audit columns."""
    w = _w(spark, sf_dir)
    path = write_csv(w.raw("transactions"), new_table_path(spark, "landing-transactions"))
    return add_audit_columns(read_csv_strings(spark, path, "transactions"), "transactions", DAY2)


def q_bronze_roundtrip(spark, sf_dir):
    """Ingest two load days into a partitioned bronze table, re-run day 1, read back."""
    w = _w(spark, sf_dir)
    csv = write_csv(w.raw("transactions"), new_table_path(spark, "landing-transactions"))
    root = new_table_path(spark, "bronze")
    ingest_csv(spark, "transactions", csv, root, DAY1)
    ingest_csv(spark, "transactions", csv, root, DAY2)
    ingest_csv(spark, "transactions", csv, root, DAY1)  # idempotent re-run of one day
    return read_bronze(spark, root, "transactions")


def q_bronze_stream(spark, sf_dir):
    """Land transactions under load_date=DAY2 and ingest them with an available-now stream."""
    w = _w(spark, sf_dir)
    root = new_table_path(spark, "stream")
    write_csv(w.raw("transactions"), f"{root}/landing/load_date={DAY2}")
    q = stream_landing_to_bronze(spark, "transactions", f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    q.awaitTermination()
    return read_bronze(spark, f"{root}/bronze", "transactions")


def q_bronze_stream_then_batch(spark, sf_dir):
    """One day arrives by the stream, another by the batch ingest; the table holds both."""
    w = _w(spark, sf_dir)
    root = new_table_path(spark, "stream")
    path = write_csv(w.raw("transactions"), f"{root}/landing/load_date={DAY1}")
    args = (spark, "transactions", f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    stream_landing_to_bronze(*args).awaitTermination()
    ingest_csv(spark, "transactions", path, f"{root}/bronze", DAY2)
    return read_bronze(spark, f"{root}/bronze", "transactions")


def q_bronze_reordered_header(spark, sf_dir):
    """Files with reversed columns and one more: columns go by header name."""
    raw = _w(spark, sf_dir).raw("transactions")
    other = raw.select(F.lit("x").alias("batch_no"), *reversed(raw.columns))
    path = write_csv(other, new_table_path(spark, "landing-transactions"))
    return add_audit_columns(read_csv_strings(spark, path, "transactions"), "transactions", DAY2)


# ---- scalar functions ------------------------------------------------------------

def q_cast_int(spark, sf_dir):
    r = _w(spark, sf_dir).raw("customers", 0)
    return r.select("customer_id", F.col("wallet_limit").alias("wallet_limit_text"), to_int("wallet_limit").alias("wallet_limit"))


def q_cast_decimal(spark, sf_dir):
    r = _w(spark, sf_dir).raw("transactions")
    return as_doubles(r.select(
        "transaction_id", F.col("txn_amount").alias("txn_amount_text"),
        to_decimal("txn_amount").alias("txn_amount"), to_decimal("platform_fee").alias("platform_fee"),
        to_decimal("cashback_amount").alias("cashback_amount"),
    ))


def q_cast_date(spark, sf_dir):
    r = _w(spark, sf_dir).raw("transactions")
    return r.select("transaction_id", F.col("txn_date").alias("txn_date_text"), to_date("txn_date").alias("txn_date"))


def q_clean_strings(spark, sf_dir):
    r = _w(spark, sf_dir).raw("customers", 0)
    return r.select(
        "customer_id", trim("full_name").alias("full_name"), lower_trim("email").alias("email"),
        initcap_trim("city").alias("city"), upper_trim("state").alias("state"),
        upper_trim("kyc_tier").alias("kyc_tier"), upper_trim("customer_segment").alias("customer_segment"),
    )


def q_fill_defaults(spark, sf_dir):
    w = _w(spark, sf_dir)
    m = silver.fill_merchant_defaults(silver.typed_merchants(w.bronze("merchants", DAY1, 0)))
    return m.select("merchant_id", "city", "state", "is_active")


def q_fill_measures(spark, sf_dir):
    w = _w(spark, sf_dir)
    t = silver.fill_transaction_defaults(silver.typed_transactions(w.bronze_transactions))
    return as_doubles(t.select("transaction_id", "txn_amount", "platform_fee", "cashback_amount", "is_fraud_flag"))


def _filled_transactions(w: Warehouse) -> DataFrame:
    return silver.fill_transaction_defaults(silver.typed_transactions(w.bronze_transactions))


def q_drop_null_keys(spark, sf_dir):
    t = drop_null_keys(_filled_transactions(_w(spark, sf_dir)), ["transaction_id", "customer_id", "merchant_id"])
    return t.select("transaction_id", "customer_id", "merchant_id")


def q_valid_transactions(spark, sf_dir):
    t = drop_null_keys(_filled_transactions(_w(spark, sf_dir)), ["transaction_id", "customer_id", "merchant_id"])
    return as_doubles(valid_transactions(t).select("transaction_id", "txn_amount", "txn_status"))


def q_dedupe_latest(spark, sf_dir):
    t = _w(spark, sf_dir).transactions
    return as_doubles(t.select("transaction_id", "txn_date", "txn_amount", "customer_id", "merchant_id", "txn_status"))


def q_net_revenue(spark, sf_dir):
    t = _w(spark, sf_dir).transactions
    return as_doubles(t.select("transaction_id", "platform_fee", "cashback_amount", "net_revenue", "txn_year", "txn_month"))


def q_date_key(spark, sf_dir):
    t = _w(spark, sf_dir).transactions
    return t.select("transaction_id", "txn_date", date_key("txn_date").alias("date_key"))


def q_record_hash(spark, sf_dir):
    m = _w(spark, sf_dir).merchants(0)
    return m.select(
        "merchant_id", record_hash(MERCHANT_TRACKED).alias("record_hash"),
        record_hash(MERCHANT_TRACKED, null_safe=True).alias("record_hash_null_safe"),
    )


def _whole_customers(w: Warehouse) -> DataFrame:
    return silver.silver_customers(w.bronze("customers", DAY1, 0), DAY1)


def q_surrogate_key(spark, sf_dir):
    c = _whole_customers(_w(spark, sf_dir)).select("customer_id")
    return dense_keys(c, "customer_id", "customer_key")


# ---- silver tables ---------------------------------------------------------------

def q_silver_customers(spark, sf_dir):
    return _whole_customers(_w(spark, sf_dir))


def q_silver_merchants(spark, sf_dir):
    return _w(spark, sf_dir).merchants(0)


def q_silver_payment_methods(spark, sf_dir):
    return _w(spark, sf_dir).payment_methods(2)


def q_silver_transactions(spark, sf_dir):
    return as_doubles(_w(spark, sf_dir).transactions)


def q_merge_update_only(spark, sf_dir):
    return _w(spark, sf_dir).customers_day2


def q_dq_rejects_dims(spark, sf_dir):
    w = _w(spark, sf_dir)
    parts = [
        silver.key_rejects(w.bronze("customers", DAY2, 0), "customers", "customer_id"),
        silver.key_rejects(w.bronze("merchants", DAY2, 0), "merchants", "merchant_id"),
        silver.key_rejects(w.bronze("payment_methods", DAY2, 2), "payment_methods", "method_id"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_update_matches(spark, sf_dir):
    w = _w(spark, sf_dir)
    return silver.update_matches(_whole_customers(w), w.raw("customer_updates"))


def q_dq_rejects(spark, sf_dir):
    return silver.transaction_rejects(_w(spark, sf_dir).bronze_transactions)


# ---- calendar --------------------------------------------------------------------

def q_dim_date(spark, sf_dir):
    return _w(spark, sf_dir).dim_date


def q_fiscal_calendar(spark, sf_dir):
    return _w(spark, sf_dir).dim_date.select("full_date", "fiscal_year", "fiscal_quarter")


# ---- SCD1 ------------------------------------------------------------------------

def q_scd1_initial(spark, sf_dir):
    return _w(spark, sf_dir).dim_merchant_day1


def q_scd1_merge(spark, sf_dir):
    return _w(spark, sf_dir).dim_merchant


def q_scd1_merge_payment(spark, sf_dir):
    return _w(spark, sf_dir).dim_payment


def q_scd1_rerun_noop(spark, sf_dir):
    w = _w(spark, sf_dir)
    return gold.load_type1("merchant", w.dim_merchant, w.merchants(2), DAY2)


# ---- SCD2 ------------------------------------------------------------------------

def q_scd2_initial(spark, sf_dir):
    return _w(spark, sf_dir).dim_customer_day1


def q_scd2_classify(spark, sf_dir):
    w = _w(spark, sf_dir)
    nk, _, tracked, cols = _CUST_ARGS
    return scd2_ops.scd2_classify(w.dim_customer_day1, w.customers_day2, nk, tracked, cols, DAY2)


def q_scd2_changed(spark, sf_dir):
    w = _w(spark, sf_dir)
    nk, _, tracked, cols = _CUST_ARGS
    return scd2_ops.scd2_source_rows(w.dim_customer_day1, w.customers_day2, nk, tracked, cols, DAY2, "changed")


def q_scd2_new(spark, sf_dir):
    w = _w(spark, sf_dir)
    nk, _, tracked, cols = _CUST_ARGS
    return scd2_ops.scd2_source_rows(w.dim_customer_day1, w.customers_day2, nk, tracked, cols, DAY2, "new")


def q_scd2_expire(spark, sf_dir):
    w = _w(spark, sf_dir)
    return scd2_ops.scd2_expire(w.dim_customer_day1, w.customers_day2, *_CUST_ARGS, DAY2)


def q_scd2_inserts(spark, sf_dir):
    w = _w(spark, sf_dir)
    return scd2_ops.scd2_inserts(w.dim_customer_day1, w.customers_day2, *_CUST_ARGS, DAY2)


def q_scd2_merge(spark, sf_dir):
    return _w(spark, sf_dir).dim_customer


def q_scd2_counts(spark, sf_dir):
    return scd2_ops.scd2_counts(_w(spark, sf_dir).dim_customer)


def q_scd2_rerun_noop(spark, sf_dir):
    w = _w(spark, sf_dir)
    return gold.load_customers(w.dim_customer, w.customers_day2, DAY2)


# ---- joins and fact ----------------------------------------------------------------

def q_join_dim_date(spark, sf_dir):
    w = _w(spark, sf_dir)
    t = gold.with_date_key(w.stored_transactions).select("transaction_id", "date_key")
    cal = w.dim_date.select("date_key", "year", "month", "month_name", "fiscal_year", "fiscal_quarter")
    return lookup_join(t, cal, "date_key")


def q_join_dim_merchant(spark, sf_dir):
    w = _w(spark, sf_dir)
    return lookup_join(w.stored_transactions, w.dim_merchant.select("merchant_id", "merchant_key"), "merchant_id").select(
        "transaction_id", "merchant_id", "merchant_key")


def q_join_dim_payment(spark, sf_dir):
    w = _w(spark, sf_dir)
    return lookup_join(w.stored_transactions, w.dim_payment.select("method_code", "payment_method_key"), "method_code").select(
        "transaction_id", "method_code", "payment_method_key")


def _pit(spark, sf_dir, **opts):
    w = _w(spark, sf_dir)
    versions = w.dim_customer.select("customer_id", "customer_key", "effective_start", "effective_end")
    t = w.stored_transactions.select("transaction_id", "customer_id", "txn_date")
    return as_of_join(t, versions, key="customer_id", at="txn_date", **opts).select(
        "transaction_id", "customer_id", "txn_date", "customer_key")


def q_point_in_time_join(spark, sf_dir):
    return _pit(spark, sf_dir)


def q_as_of_join_salted(spark, sf_dir):
    """The shuffle path of the as-of join, with every customer treated as hot."""
    return _pit(spark, sf_dir, max_broadcast_rows=0, hot_key_rows=1, salt_buckets=8)


def q_as_of_join_ordered(spark, sf_dir):
    """The as-of join as one ordered stream of versions and facts."""
    w = _w(spark, sf_dir)
    versions = w.dim_customer.select("customer_id", "customer_key", "effective_start", "effective_end")
    t = w.stored_transactions.select("transaction_id", "customer_id", "txn_date")
    return as_of_join_ordered(t, versions, key="customer_id", at="txn_date").select("transaction_id", "customer_id", "txn_date", "customer_key")


def q_scd2_audit(spark, sf_dir):
    """The customer history with planted faults: ends moved by rule of the key, flags flipped, keys turned round."""
    k, end = F.col("customer_key"), F.col("effective_end")
    planted = _w(spark, sf_dir).dim_customer.select(
        "customer_id",
        F.when(k % 7 == 0, -k).otherwise(k).alias("customer_key"),
        "effective_start",
        F.when(k % 5 == 0, F.date_sub(end, 3)).when(k % 5 == 1, F.date_add(end, 4)).otherwise(end).alias("effective_end"),
        F.when(k % 11 == 0, 1 - F.col("is_current")).otherwise(F.col("is_current")).alias("is_current"),
    )
    return interval_audit(planted, "customer_id", "customer_key")


def q_fact_transaction(spark, sf_dir):
    return as_doubles(_w(spark, sf_dir).fact)


def q_fact_partition_roundtrip(spark, sf_dir):
    """Write the fact partitioned by year and month, read it back."""
    path = new_table_path(spark, "fact_transaction")
    write_table(_w(spark, sf_dir).fact, path, partition_by=["txn_year", "txn_month"], dynamic=True)
    return as_doubles(read_table(spark, path).select(*FACT_COLUMNS))


def q_fact_quality(spark, sf_dir):
    w = _w(spark, sf_dir)
    return gold.fact_quality(w.fact, w.dim_date)


# The calendar of these two ends before the last transactions.
SHORT_CALENDAR = ("1992-01-01", "1996-12-31")
Q1_RANGE = ("1994-11-16", "1996-02-10")


def q_fact_quality_short_calendar(spark, sf_dir):
    return gold.fact_quality(_w(spark, sf_dir).fact, dim_date(spark, *SHORT_CALENDAR))


def q1_range(spark, sf_dir):
    """Q1 of the facts between two dates, read from the stored months they lie in."""
    lake = _stored(spark, sf_dir)
    return as_doubles(reports.monthly_gmv(lake.facts_between(spark, *Q1_RANGE), lake.read(spark, "gold.dim_date")))


def q1_short_calendar(spark, sf_dir):
    """Q1 joins the calendar, so facts outside it drop out."""
    return as_doubles(reports.monthly_gmv(_w(spark, sf_dir).fact, dim_date(spark, *SHORT_CALENDAR)))


def q_fact_shared_method_code(spark, sf_dir):
    """Two payment methods share a code: the fact keeps its grain and takes the smaller method id."""
    w = _w(spark, sf_dir)
    shared = w.dim_payment.withColumn("method_code", F.when(F.col("method_id") == "PM-002", F.lit("UPI")).otherwise(F.col("method_code")))
    return as_doubles(gold.fact_transaction(w.stored_transactions, w.dim_customer, w.dim_merchant, shared, DAY2))


def q_payment_code_conflicts(spark, sf_dir):
    shared = _w(spark, sf_dir).dim_payment.withColumn("method_code", F.when(F.col("method_id") == "PM-002", F.lit("UPI")).otherwise(F.col("method_code")))
    return gold.payment_code_conflicts(shared)


def q_fact_spread_joins(spark, sf_dir):
    """The fact with every dimension over the broadcast bound: sort-merge joins, every frequent key spread."""
    w = _w(spark, sf_dir)
    return as_doubles(gold.fact_transaction(
        w.stored_transactions, w.dim_customer, w.dim_merchant, w.dim_payment, DAY2, max_broadcast_rows=0, hot_key_rows=20, salt_buckets=8))


def q_layer_row_counts(spark, sf_dir):
    w = _w(spark, sf_dir)
    frames = {
        "bronze.customers": w.raw("customers", 2),
        "bronze.customer_updates": w.raw("customer_updates"),
        "bronze.merchants": w.raw("merchants", 2),
        "bronze.payment_methods": w.raw("payment_methods", 2),
        "bronze.transactions": w.raw("transactions"),
        "silver.customers": w.customers_day2,
        "silver.merchants": w.merchants(2),
        "silver.payment_methods": w.payment_methods(2),
        "silver.transactions": w.stored_transactions,
        "gold.dim_customer": w.dim_customer,
        "gold.dim_merchant": w.dim_merchant,
        "gold.dim_payment_method": w.dim_payment,
        "gold.dim_date": w.dim_date,
        "gold.fact_transaction": w.fact,
    }
    return pipeline.layer_counts(frames)


def q_pipeline_end_to_end(spark, sf_dir):
    lake = pipeline.run_pipeline(spark, sf_dir)
    return pipeline.layer_counts(pipeline.lakehouse_frames(spark, lake))


def _stored(spark, sf_dir) -> pipeline.Lakehouse:
    """The two-day warehouse as the daily loads store it, once a session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STORED:
        _STORED[key] = pipeline.run_pipeline(spark, sf_dir)
    return _STORED[key]


_STORED: dict[tuple[str, str], pipeline.Lakehouse] = {}


def q_pipeline_fact(spark, sf_dir):
    return as_doubles(_stored(spark, sf_dir).read(spark, "gold.fact_transaction").select(*FACT_COLUMNS))


def q_pipeline_dim_customer(spark, sf_dir):
    return _stored(spark, sf_dir).read(spark, "gold.dim_customer")


def q_pipeline_dim_payment(spark, sf_dir):
    return _stored(spark, sf_dir).read(spark, "gold.dim_payment_method")


def q_pipeline_silver_customers(spark, sf_dir):
    return _stored(spark, sf_dir).read(spark, "silver.customers")


def q_pipeline_silver_merchants(spark, sf_dir):
    return _stored(spark, sf_dir).read(spark, "silver.merchants")


def q_pipeline_quality(spark, sf_dir):
    """The profile that the day's load recorded."""
    found = _stored(spark, sf_dir).quality[DAY2]
    row = {**found["dq_rejects"], **found["fact_quality"]}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} long" for c in row))


def q_pipeline_rerun_day(spark, sf_dir):
    """Day 2 loaded twice: the customer dimension with its history, unchanged."""
    lake = pipeline.run_pipeline(spark, sf_dir)
    return pipeline.load_day(spark, lake, DAY2, pipeline.DAY2_FEEDS).read(spark, "gold.dim_customer")


def q_pipeline_reopen(spark, sf_dir):
    """Day 1 by one warehouse object, day 2 by another that only knows the folder."""
    root = new_table_path(spark, "lakehouse")
    first = pipeline.Lakehouse(root)
    pipeline.land_day1(spark, first, sf_dir.rstrip("/"))
    pipeline.load_day(spark, first, DAY1, pipeline.DAY1_FEEDS)
    second = pipeline.Lakehouse.open(spark, root)
    pipeline.land_day2(spark, second, sf_dir.rstrip("/"))
    pipeline.load_day(spark, second, DAY2, pipeline.DAY2_FEEDS)
    return pipeline.Lakehouse.open(spark, root).read(spark, "gold.dim_customer")


def q_fact_two_days(spark, sf_dir):
    """Transactions arrive on two days, with ids in common: the facts of both days, each id once."""
    lake = pipeline.run_pipeline(spark, sf_dir, part="first")
    pipeline.land(spark, lake, "transactions", fixtures.raw_transactions(spark, sf_dir.rstrip("/"), "second"), DAY3)
    pipeline.load_day(spark, lake, DAY3, {"transactions"})
    return as_doubles(lake.read(spark, "gold.fact_transaction").select(*FACT_COLUMNS))


def _by_ids(spark, lake):
    """The facts with the ids and versions that their keys stand for, whatever the numbers of the keys."""
    customers, merchants, methods = (lake.read(spark, f"gold.dim_{n}") for n in ("customer", "merchant", "payment_method"))
    rows = (
        lake.read(spark, "gold.fact_transaction")
        .join(customers.select("customer_key", "customer_id", "effective_start", "effective_end", "is_current", "kyc_tier"), "customer_key", "left")
        .join(merchants.select("merchant_key", "merchant_id", "category", "updated_at"), "merchant_key", "left")
        .join(methods.select("payment_method_key", "method_id", "method_name"), "payment_method_key", "left")
    )
    return as_doubles(rows.select(
        "transaction_id", "txn_date", "txn_amount", "net_revenue", "created_at", "customer_id", "effective_start", "effective_end",
        "is_current", "kyc_tier", "merchant_id", "category", "updated_at", "method_id", "method_name",
    ))


def q_pipeline_late_day(spark, sf_dir):
    """Day 2 is loaded first and day 1 after it: the facts and versions of loading in order."""
    lake, d = pipeline.Lakehouse(new_table_path(spark, "lakehouse")), sf_dir.rstrip("/")
    pipeline.land_day2(spark, lake, d)
    pipeline.load_day(spark, lake, DAY2, pipeline.DAY2_FEEDS)
    pipeline.land_day1(spark, lake, d)
    pipeline.load_day(spark, lake, DAY1, pipeline.DAY1_FEEDS)
    return _by_ids(spark, lake)


def q_fact_late_part(spark, sf_dir):
    """Day 3 is loaded before day 2, whose transactions share ids with it and whose customers open new versions."""
    lake, d = pipeline.Lakehouse(new_table_path(spark, "lakehouse")), sf_dir.rstrip("/")
    pipeline.land_day1(spark, lake, d)
    pipeline.load_day(spark, lake, DAY1, pipeline.DAY1_FEEDS)
    pipeline.land(spark, lake, "transactions", fixtures.raw_transactions(spark, d, "second"), DAY3)
    pipeline.load_day(spark, lake, DAY3, {"transactions"})
    pipeline.land_day2(spark, lake, d, "first")
    pipeline.load_day(spark, lake, DAY2, pipeline.DAY2_FEEDS)
    return _by_ids(spark, lake)


def q_fact_rekeyed(spark, sf_dir):
    """A third of the customers and half of the merchants arrive a day after their transactions: the facts get their keys then."""
    lake, d = pipeline.Lakehouse(new_table_path(spark, "lakehouse")), sf_dir.rstrip("/")
    customers, merchants = fixtures.raw_customers(spark, d, 1), fixtures.raw_merchants(spark, d, 1)
    late = lambda column, of: F.coalesce(F.regexp_extract(column, r"\d+$", 0).cast("int") % of == 0, F.lit(False))
    pipeline.land(spark, lake, "customers", customers.where(~late("customer_id", 3)), DAY1)
    pipeline.land(spark, lake, "merchants", merchants.where(~late("merchant_id", 2)), DAY1)
    pipeline.land(spark, lake, "payment_methods", fixtures.raw_payment_methods(spark, d, 1), DAY1)
    pipeline.load_day(spark, lake, DAY1, pipeline.DAY1_FEEDS)
    pipeline.land(spark, lake, "transactions", fixtures.raw_transactions(spark, d), DAY2)
    pipeline.load_day(spark, lake, DAY2, {"transactions"})
    pipeline.land(spark, lake, "customers", customers, DAY3)
    pipeline.land(spark, lake, "merchants", merchants, DAY3)
    pipeline.load_day(spark, lake, DAY3, {"customers", "merchants"})
    return _by_ids(spark, lake).select("transaction_id", "txn_date", "txn_amount", "customer_id", "effective_start", "kyc_tier", "merchant_id", "category")


def _three_days(spark, sf_dir) -> pipeline.Lakehouse:
    """Transactions of day 2 before the customers of that day change tiers on day 3, whose transactions follow; once a session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "three")
    if key not in _STORED:
        lake, d = pipeline.Lakehouse(new_table_path(spark, "lakehouse")), sf_dir.rstrip("/")
        pipeline.land_day1(spark, lake, d)
        pipeline.load_day(spark, lake, DAY1, pipeline.DAY1_FEEDS)
        pipeline.land_day2(spark, lake, d, "first")
        pipeline.load_day(spark, lake, DAY2, pipeline.DAY2_FEEDS)
        pipeline.land(spark, lake, "customers", fixtures.raw_customers(spark, d, 1), DAY3)
        pipeline.land(spark, lake, "transactions", fixtures.raw_transactions(spark, d, "second"), DAY3)
        pipeline.load_day(spark, lake, DAY3, {"customers", "transactions"})
        _STORED[key] = lake
    return _STORED[key]


def q4_incremental(spark, sf_dir):
    """Q4 over three days from the states that each day's facts left; versions closed on day 3 fall out."""
    lake = _three_days(spark, sf_dir)
    return as_doubles(states.segment_revenue(lake.read(spark, pipeline.SPEND), lake.read(spark, "gold.dim_customer")))


def q5_bitmap_customers(spark, sf_dir):
    """Q5 over three days, its distinct customers from bitmaps per day and tier."""
    lake = _three_days(spark, sf_dir)
    spend, bitmaps = lake.read(spark, pipeline.SPEND), lake.read(spark, pipeline.TIER_CUSTOMERS)
    return as_doubles(states.kyc_point_in_time(spend, bitmaps, lake.read(spark, "gold.dim_customer")))


def q_bronze_empty_day(spark, sf_dir):
    """Two days landed, then the first one again by a feed that has no rows any more."""
    root, feed = new_table_path(spark, "bronze"), fixtures.raw_merchants(spark, sf_dir.rstrip("/"), 1)
    for day, rows in ((DAY1, feed), (DAY2, feed), (DAY1, feed.limit(0))):
        path = new_table_path(spark, "csv")
        write_csv(rows, path)
        ingest_csv(spark, "merchants", path, root, day)
    return read_bronze(spark, root, "merchants")


def _faulty_landing(spark, sf_dir) -> str:
    """Transactions landed as text lines; lines of some lengths lose fields, gain one or open a quote that never closes."""
    raw = _w(spark, sf_dir).raw("transactions")
    fields = [F.coalesce(c, F.lit("")) for c in raw.columns]
    line, short = F.concat_ws(",", *fields), F.concat_ws(",", *fields[:6])
    kind = F.length(line) % 10
    faulty = F.when(kind == 3, short).when(kind == 7, F.concat(line, F.lit(",more"))).when(kind == 5, F.concat(F.lit('"'), short)).otherwise(line)
    path = new_table_path(spark, "landing-faulty")
    raw.select(faulty.alias(",".join(raw.columns))).write.option("header", True).option("quote", "").option("sep", "\x01").option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def q_bronze_quarantine(spark, sf_dir):
    """A feed with malformed lines: the good ones in bronze, the others in quarantine with what is wrong."""
    root = new_table_path(spark, "bronze")
    ingest_csv(spark, "transactions", _faulty_landing(spark, sf_dir), root, DAY2)
    good, bad = read_bronze(spark, root, "transactions"), read_quarantine(spark, root, "transactions")
    none = [F.lit(None).cast("string").alias(c) for c in bad.columns if c in ("reason", "line")]
    counts = [F.lit(None).cast("int").alias(c) for c in ("found_fields", "expected_fields")]
    return good.select(*good.columns, *none, *counts).unionByName(bad.drop("source", "landed_file", "first_field"), allowMissingColumns=True)


def q_sql_views_q5b(spark, sf_dir):
    """The version comparison in SQL over the registered views of the stored warehouse."""
    register_views(spark, _stored(spark, sf_dir))
    return as_doubles(spark.sql(
        "WITH spent AS (SELECT customer_key, count(transaction_id) AS n, sum(txn_amount) AS amount FROM fact_transaction GROUP BY customer_key)"
        " SELECT kyc_tier AS kyc_tier_at_txn_time, is_current, sum(n) AS transactions, sum(amount) AS gmv"
        " FROM dim_customer JOIN spent USING (customer_key) GROUP BY ALL ORDER BY 1, 2"
    ))


# ---- reports -----------------------------------------------------------------------

def q1_monthly_gmv(spark, sf_dir):
    w = _w(spark, sf_dir)
    return as_doubles(reports.monthly_gmv(w.fact, w.dim_date))


def q2_top_merchants(spark, sf_dir):
    w = _w(spark, sf_dir)
    return as_doubles(reports.top_merchants(w.fact, w.dim_merchant))


def q3_payment_methods(spark, sf_dir):
    w = _w(spark, sf_dir)
    return as_doubles(reports.payment_method_success(w.fact, w.dim_payment))


def q4_segment_revenue(spark, sf_dir):
    w = _w(spark, sf_dir)
    return as_doubles(reports.segment_revenue(w.fact, w.dim_customer))


def q5_kyc_point_in_time(spark, sf_dir):
    w = _w(spark, sf_dir)
    return as_doubles(reports.kyc_point_in_time(w.fact, w.dim_customer))


def q5b_version_split(spark, sf_dir):
    w = _w(spark, sf_dir)
    return as_doubles(reports.version_split(w.fact, w.dim_customer))


QUERIES: dict[str, Query] = {
    "bronze_ingest": q_bronze_ingest,
    "bronze_roundtrip": q_bronze_roundtrip,
    "bronze_stream": q_bronze_stream,
    "cast_int": q_cast_int,
    "cast_decimal": q_cast_decimal,
    "cast_date": q_cast_date,
    "clean_strings": q_clean_strings,
    "fill_defaults": q_fill_defaults,
    "fill_measures": q_fill_measures,
    "drop_null_keys": q_drop_null_keys,
    "valid_transactions": q_valid_transactions,
    "dedupe_latest": q_dedupe_latest,
    "net_revenue": q_net_revenue,
    "silver_customers": q_silver_customers,
    "silver_merchants": q_silver_merchants,
    "silver_payment_methods": q_silver_payment_methods,
    "silver_transactions": q_silver_transactions,
    "merge_update_only": q_merge_update_only,
    "dq_rejects": q_dq_rejects,
    "dq_rejects_dims": q_dq_rejects_dims,
    "update_matches": q_update_matches,
    "dim_date": q_dim_date,
    "fiscal_calendar": q_fiscal_calendar,
    "date_key": q_date_key,
    "record_hash": q_record_hash,
    "surrogate_key": q_surrogate_key,
    "scd1_initial": q_scd1_initial,
    "scd1_merge": q_scd1_merge,
    "scd1_merge_payment": q_scd1_merge_payment,
    "scd1_rerun_noop": q_scd1_rerun_noop,
    "scd2_initial": q_scd2_initial,
    "scd2_classify": q_scd2_classify,
    "scd2_changed": q_scd2_changed,
    "scd2_new": q_scd2_new,
    "scd2_expire": q_scd2_expire,
    "scd2_inserts": q_scd2_inserts,
    "scd2_merge": q_scd2_merge,
    "scd2_counts": q_scd2_counts,
    "scd2_rerun_noop": q_scd2_rerun_noop,
    "join_dim_date": q_join_dim_date,
    "join_dim_merchant": q_join_dim_merchant,
    "join_dim_payment": q_join_dim_payment,
    "point_in_time_join": q_point_in_time_join,
    "as_of_join_salted": q_as_of_join_salted,
    "as_of_join_ordered": q_as_of_join_ordered,
    "scd2_audit": q_scd2_audit,
    "fact_transaction": q_fact_transaction,
    "fact_partition_roundtrip": q_fact_partition_roundtrip,
    "fact_quality": q_fact_quality,
    "layer_row_counts": q_layer_row_counts,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "bronze_stream_then_batch": q_bronze_stream_then_batch,
    "bronze_reordered_header": q_bronze_reordered_header,
    "fact_quality_short_calendar": q_fact_quality_short_calendar,
    "q1_short_calendar": q1_short_calendar,
    "fact_shared_method_code": q_fact_shared_method_code,
    "payment_code_conflicts": q_payment_code_conflicts,
    "fact_spread_joins": q_fact_spread_joins,
    "pipeline_fact": q_pipeline_fact,
    "pipeline_dim_customer": q_pipeline_dim_customer,
    "pipeline_dim_payment": q_pipeline_dim_payment,
    "pipeline_silver_customers": q_pipeline_silver_customers,
    "pipeline_silver_merchants": q_pipeline_silver_merchants,
    "pipeline_quality": q_pipeline_quality,
    "pipeline_rerun_day": q_pipeline_rerun_day,
    "pipeline_reopen": q_pipeline_reopen,
    "fact_two_days": q_fact_two_days,
    "pipeline_late_day": q_pipeline_late_day,
    "fact_late_part": q_fact_late_part,
    "fact_rekeyed": q_fact_rekeyed,
    "q1_range": q1_range,
    "q4_incremental": q4_incremental,
    "q5_bitmap_customers": q5_bitmap_customers,
    "bronze_empty_day": q_bronze_empty_day,
    "bronze_quarantine": q_bronze_quarantine,
    "sql_views_q5b": q_sql_views_q5b,
    "q1_monthly_gmv": q1_monthly_gmv,
    "q2_top_merchants": q2_top_merchants,
    "q3_payment_methods": q3_payment_methods,
    "q4_segment_revenue": q4_segment_revenue,
    "q5_kyc_point_in_time": q5_kyc_point_in_time,
    "q5b_version_split": q5b_version_split,
}
