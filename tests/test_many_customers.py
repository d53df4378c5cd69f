"""Customers that outgrow a broadcast: facts get their keys without being shuffled, missing ids meet by id, transactions are shuffled by few columns."""

import pytest
from pyspark.sql import functions as F

from paymart import registry
from paymart.plans import pipeline, silver
from paymart.schemas import RAW_COLUMNS
from paymart.sources.bronze import add_audit_columns
from paymart.sources.storage import new_table_path, read_table, write_table


def _many_customers(monkeypatch):
    """Customers, and nothing else, outgrow a broadcast."""
    fits = pipeline.known_to_fit
    monkeypatch.setattr(pipeline, "known_to_fit", lambda rows, longest, columns: columns != 4 and fits(rows, longest, columns))


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_facts_of_many_customers_stay_in_their_months(spark, sf_small, monkeypatch):
    few = pipeline.run_pipeline(spark, sf_small)
    _many_customers(monkeypatch)
    logical, physical = {}, {}

    def spy(df, path, *args, **options):
        name = path.split("/load_day=")[0].rsplit("/", 1)[-1]
        query = df._jdf.queryExecution()
        logical[name], physical[name] = query.optimizedPlan().toString(), query.executedPlan().toString()
        return write_table(df, path, *args, **options)

    monkeypatch.setattr(pipeline, "write_table", spy)
    many = pipeline.run_pipeline(spark, sf_small)
    assert "Rebalance" in logical["transactions"] and "Rebalance" not in logical["fact_transaction"]
    assert "SortMergeJoin" not in physical["fact_transaction"]
    # a row passes one shuffle on its way to the months; to its customer go id, customer and date
    [asked] = [line for line in logical["transactions"].splitlines() if " AS _salt#" in line]
    assert "txn_amount" not in asked and "merchant_id" not in asked
    moved = logical["transactions"].split("Rebalance")[1]
    assert "net_revenue" not in moved and "silver_loaded_at" not in moved
    for name in (*pipeline.BY_DAY, "gold.dim_customer"):
        assert many.read(spark, name).dtypes == few.read(spark, name).dtypes, name
        assert _rows(many.read(spark, name)) == _rows(few.read(spark, name)), name
    assert many.quality == few.quality
    assert _rows(pipeline.Lakehouse.open(spark, many.root).read(spark, "silver.transactions")) == _rows(few.read(spark, "silver.transactions"))


@pytest.mark.parametrize("query", ["fact_two_days", "fact_rekeyed", "fact_late_part"])
def test_loads_of_several_days_with_many_customers(spark, sf_small, monkeypatch, query):
    few = _rows(registry.QUERIES[query](spark, sf_small))
    _many_customers(monkeypatch)
    assert _rows(registry.QUERIES[query](spark, sf_small)) == few


def test_the_deduplication_is_shuffled_once_for_rows_and_keys(spark, sf_small, monkeypatch):
    _many_customers(monkeypatch)
    plans = []

    def spy(df, path, *args, **options):
        if "/silver/transactions/" in path:
            spark.conf.set("spark.sql.adaptive.enabled", False)  # adaptive plans show reuse only after they ran
            try:
                plans.append(df.select("*")._jdf.queryExecution().executedPlan().toString())
            finally:
                spark.conf.set("spark.sql.adaptive.enabled", True)
        return write_table(df, path, *args, **options)

    monkeypatch.setattr(pipeline, "write_table", spy)
    pipeline.run_pipeline(spark, sf_small)
    [plan] = plans
    assert sum("ReusedExchange [transaction_id#" in line for line in plan.splitlines()) == 1
    assert sum("FileScan parquet [transaction_id#" in line for line in plan.splitlines()) == 1


def _bronze(spark, rows):
    raw = spark.createDataFrame(
        [{**dict.fromkeys(RAW_COLUMNS["transactions"]), "customer_id": "C", "merchant_id": "M", "txn_status": "SUCCESS", "txn_amount": "1.00", **r} for r in rows],
        ", ".join(f"{c} string" for c in RAW_COLUMNS["transactions"]))
    return raw


def test_unusual_audit_columns_are_kept(spark):
    """The usual ones are not shuffled; others, NULL among them, come back as they were."""
    usual = add_audit_columns(_bronze(spark, [{"transaction_id": "T1"}]), "transactions", "2024-03-01")
    other = add_audit_columns(_bronze(spark, [{"transaction_id": "T2"}]), "transactions", "2024-03-01", "2024-03-01 07:00:00")
    none = add_audit_columns(_bronze(spark, [{"transaction_id": "T3"}]), "transactions", "2024-03-01").withColumn("source_file", F.lit(None).cast("string"))
    path = write_table(usual.unionByName(other).unionByName(none), new_table_path(spark, "audit"))
    found = silver.silver_transactions(read_table(spark, path), "2024-03-01").orderBy("transaction_id").collect()
    assert [(r.load_timestamp, r.source_file, r.load_date) for r in found] == [
        ("2024-03-01 00:00:00", "transactions.csv", "2024-03-01"),
        ("2024-03-01 07:00:00", "transactions.csv", "2024-03-01"),
        ("2024-03-01 00:00:00", None, "2024-03-01"),
    ]
