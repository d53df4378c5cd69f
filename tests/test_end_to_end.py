"""Whole-warehouse checks at sf0.001: oracle parity, plan shape, pipeline."""

import datetime
import decimal
import os

import duckdb
import pytest

from __spark_entry__ import entry
from __spark_entry__ import queries as all_queries
from paymart.oracle import oracle_sql
from paymart.plans import pipeline
from paymart.registry import QUERIES, as_doubles


def queries():
    return QUERIES



TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
WRITES = {
    "bronze_ingest", "bronze_roundtrip", "bronze_stream", "bronze_stream_then_batch", "bronze_reordered_header",
    "fact_partition_roundtrip", "fact_two_days", "sql_views_q5b",
    *(q for q in QUERIES if q.startswith("pipeline_")),
}


def _norm(v):
    if isinstance(v, float | decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


# The whole registry is compared at sf0.01 by tools/check_oracle.py; here a
# representative slice runs at sf0.001 (PAYMART_FULL_TESTS=1: every query).
FULL = os.environ.get("PAYMART_FULL_TESTS") == "1"
PARITY = sorted(queries()) if FULL else [
    "merge_update_only", "scd2_merge", "fact_transaction", "as_of_join_salted",
    "q1_monthly_gmv", "q2_top_merchants", "q4_segment_revenue", "q5_kyc_point_in_time",
    "q1_short_calendar", "fact_quality_short_calendar", "fact_shared_method_code", "fact_spread_joins",
    "bronze_reordered_header", "bronze_stream_then_batch", "pipeline_fact", "pipeline_dim_customer",
    "pipeline_silver_customers", "pipeline_quality", "sql_views_q5b", "fact_two_days",
]
PLAN_SWEEP = sorted(set(queries()) - WRITES) if FULL else [
    "dedupe_latest", "scd1_merge", "scd2_merge", "surrogate_key", "point_in_time_join",
    "as_of_join_salted", "fact_quality", "q1_monthly_gmv", "q2_top_merchants", "q4_segment_revenue",
]


@pytest.mark.parametrize("name", PARITY)
def test_oracle_parity(spark, duck, sf_small, name):
    df = queries()[name](spark, sf_small)
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, df.collect()) == _rows(ocols, cur.fetchall())


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(all_queries())


def test_plans_have_no_cross_joins(spark, sf_small):
    for name in PLAN_SWEEP:
        plan = queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[:3] == ["year", "month_name", "month"]
    assert df.count() > 0


def test_pipeline_writes_every_layer(spark, duck, sf_small):
    lake = pipeline.run_pipeline(spark, sf_small)
    got = pipeline.layer_counts(pipeline.lakehouse_frames(spark, lake))
    want = duck.execute(oracle_sql()["pipeline_end_to_end"]).fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    observed = {name: lake.rows[entry] for _, name, entry in pipeline.LAYER_TABLES if entry in lake.rows}
    assert observed and all(observed[n] == c for _, n, c in want if n in observed)
    # the gold tables answer ad-hoc SQL through views, equal to the DataFrame report
    from paymart.plans import reports
    from paymart.plans.views import register_views
    assert register_views(spark, lake) == sorted(["fact_transaction", "dim_customer", "dim_merchant",
                                                  "dim_payment_method", "dim_date"])
    sql = spark.sql(
        "SELECT c.kyc_tier AS kyc_tier_at_txn_time, c.is_current, COUNT(f.transaction_id) AS transactions, "
        "SUM(f.txn_amount) AS gmv FROM fact_transaction f "
        "JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY c.kyc_tier, c.is_current"
    )
    df = reports.version_split(lake.read(spark, "gold.fact_transaction"), lake.read(spark, "gold.dim_customer"))
    assert sorted(sql.collect()) == sorted(df.collect())
    assert dict(df.dtypes)["gmv"].startswith("decimal") and dict(as_doubles(df).dtypes)["gmv"] == "double"
    # over stored tables the report's filter and columns reach the scan of the fact
    q1 = reports.monthly_gmv(lake.read(spark, "gold.fact_transaction"), lake.read(spark, "gold.dim_date"))
    plan = q1._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(txn_status,SUCCESS)" in plan and "failure_reason" not in plan
    fact = lake.read(spark, "gold.fact_transaction")
    assert fact.count() == fact.select("transaction_id").distinct().count()  # grain kept
    from pyspark.sql import functions as F
    money = [F.sum(c).alias(c) for c in ("txn_amount", "platform_fee", "cashback_amount", "net_revenue")]
    assert fact.agg(*money).first() == lake.read(spark, "silver.transactions").agg(*money).first()  # totals kept
