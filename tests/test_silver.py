import pytest
from pyspark.sql import functions as F

from paymart.plans import silver
from paymart.schemas import RAW_COLUMNS
from paymart.sources.bronze import add_audit_columns

CUST = RAW_COLUMNS["customers"]
UPD = RAW_COLUMNS["customer_updates"]


def _customers(spark):
    rows = [("C1", " Ann ", " A@X.COM", "1", " pune", "mh ", " basic", "100", "vip", "2020-01-01"),
            ("C2", "Bo", "b@x.com", "2", None, None, "Full", "n/a", None, "bad"),
            (None, "Nobody", "n@x.com", "3", None, None, "Full", "1", None, None)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CUST))
    return silver.silver_customers(add_audit_columns(raw, "customers", "2024-01-01"), "2024-01-01")


def test_silver_customers(spark):
    rows = {r.customer_id: r for r in _customers(spark).collect()}
    assert set(rows) == {"C1", "C2"}
    c1, c2 = rows["C1"], rows["C2"]
    assert (c1.full_name, c1.email, c1.city, c1.state, c1.kyc_tier, c1.wallet_limit) == ("Ann", "a@x.com", "Pune", "MH", "BASIC", 100)
    assert (c2.city, c2.state, c2.customer_segment, c2.wallet_limit, c2.created_date) == ("UNKNOWN", "UNKNOWN", "UNKNOWN", None, None)
    assert c1.is_active == 1 and c1.silver_loaded_at == "2024-01-01 00:00:00"


def _updates(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in UPD))


def test_update_only_merge(spark):
    cust = _customers(spark)
    upd = _updates(spark, [("C1", "x", "x", "x", " mumbai", "mh", "premium", "900", "regular", "2020-01-01", "2024-02-01"),
                           ("C9", "x", "x", "x", "x", "x", "full", "1", "vip", "2020-01-01", "2024-02-01")])
    out = {r.customer_id: r for r in silver.apply_customer_updates(cust, upd, "2024-02-02").collect()}
    assert set(out) == {"C1", "C2"}                          # unmatched update ignored, nothing deleted
    assert (out["C1"].kyc_tier, out["C1"].wallet_limit, out["C1"].city, out["C1"].full_name) == ("PREMIUM", 900, "Mumbai", "Ann")
    assert out["C2"].silver_loaded_at == "2024-01-01 00:00:00"


def test_update_duplicates(spark):
    cust = _customers(spark)
    upd = _updates(spark, [("C1", "x", "x", "x", "a", "mh", "premium", "900", "vip", "2020-01-01", "2024-02-01"),
                           ("C1", "x", "x", "x", "a", "mh", "full", "700", "vip", "2020-01-01", "2024-03-01")])
    with pytest.raises(Exception, match="several updates"):
        silver.apply_customer_updates(cust, upd, "2024-03-02").collect()
    latest = silver.apply_customer_updates(cust, upd, "2024-03-02", on_duplicate="latest")
    assert latest.filter(F.col("customer_id") == "C1").first().kyc_tier == "FULL"


def test_transaction_rules_and_rejects(spark):
    cols = RAW_COLUMNS["transactions"]
    rows = [
        ("T1", "C1", "M1", " upi", "2024-01-05", "10.00", "0.10", "0.00", " success ", None, "0"),
        ("T1", "C1", "M1", "upi", "2024-01-06", "5.00", "0.05", "0.00", "SUCCESS", None, "0"),   # later date wins
        ("T2", None, "M1", "upi", "2024-01-05", "1.00", "0.01", "0.00", "SUCCESS", None, "0"),   # null key
        ("T3", "C1", "M1", "upi", "2024-01-05", "-1.00", "0.01", "0.00", "SUCCESS", None, "0"),  # negative
        ("T4", "C1", "M1", "upi", "2024-01-05", "1.00", "0.01", "0.00", "REVERSED", None, "0"),  # status
        ("T5", "C1", "M1", "upi", None, "bad", None, "0.00", "failed", "timeout ", None),        # defaulted
    ]
    raw = add_audit_columns(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)), "transactions", "2024-02-01")
    out = {r.transaction_id: r for r in silver.silver_transactions(raw, "2024-02-01").collect()}
    assert set(out) == {"T1", "T5"}
    assert str(out["T1"].txn_amount) == "5.00" and out["T1"].txn_month == 1
    t5 = out["T5"]
    assert str(t5.txn_amount) == "0.00" and t5.is_fraud_flag == 0 and t5.failure_reason == "TIMEOUT" and t5.txn_year is None
    assert str(t5.net_revenue) == "0.00"
    r = silver.transaction_rejects(raw).first()
    assert (r.rows_in, r.null_key_rejects, r.negative_amount_rejects, r.invalid_status_rejects,
            r.rows_valid, r.distinct_valid_ids, r.amount_defaulted) == (6, 1, 1, 1, 3, 2, 1)
