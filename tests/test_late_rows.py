"""Dimension rows that arrive after their facts, and report states kept by load day."""

import pytest
from pyspark.sql import functions as F

from paymart.plans import pipeline, reports, states
from paymart.schemas import RAW_COLUMNS
from paymart.sources.storage import new_table_path

DAYS = ["2024-03-01", "2024-03-02", "2024-03-03"]
FACT = "gold.fact_transaction"


def _feed(spark, source, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS[source]))


def _load(spark, lake, day, customers=None, merchants=None, txn=None):
    """``customers``: id -> (tier, created, city); ``merchants``: ids; ``txn``: (id, customer, merchant, date)."""
    sources = set()
    if customers is not None:
        rows = [(c, "n", "e", "p", city, "s", tier, "1", "a", created) for c, (tier, created, city) in customers.items()]
        pipeline.land(spark, lake, "customers", _feed(spark, "customers", rows), day)
        sources.add("customers")
    if merchants is not None:
        pipeline.land(spark, lake, "merchants", _feed(spark, "merchants", [(m, "m", "c", "s", "c", "s", "1", "2024-01-01") for m in merchants]), day)
        sources.add("merchants")
    if day == DAYS[0]:
        pipeline.land(spark, lake, "payment_methods", _feed(spark, "payment_methods", [("P1", "UPI", "u", "t", "1")]), day)
        sources.add("payment_methods")
    if txn is not None:
        rows = [(i, c, m, "UPI", on, "10.00", "1.00", "0.50", "SUCCESS", None, "0") for i, c, m, on in txn]
        pipeline.land(spark, lake, "transactions", _feed(spark, "transactions", rows), day)
        sources.add("transactions")
    return pipeline.load_day(spark, lake, day, sources)


def _keys(spark, lake):
    """transaction -> (customer, merchant) that its keys stand for."""
    c = lake.read(spark, "gold.dim_customer").select("customer_key", "customer_id")
    m = lake.read(spark, "gold.dim_merchant").select("merchant_key", "merchant_id")
    rows = lake.read(spark, FACT).join(c, "customer_key", "left").join(m, "merchant_key", "left")
    return {r.transaction_id: (r.customer_id, r.merchant_id) for r in rows.collect()}


@pytest.fixture()
def lake(spark):
    return pipeline.Lakehouse(new_table_path(spark, "lake-test"))


C1 = {"C1": ("BASIC", "2024-01-01", "x")}
FEB, MARCH = "2024-02-10", "2024-03-01"


def test_late_rows_rekey_only_the_months_concerned(spark, lake):
    txn = [("T1", "C1", "M1", FEB), ("T2", "C9", "M1", MARCH), ("T3", "C1", "M9", MARCH), ("T4", "C8", "M1", FEB)]
    _load(spark, lake, DAYS[0], C1, ["M1"], txn)
    assert _keys(spark, lake) == {"T1": ("C1", "M1"), "T2": (None, "M1"), "T3": ("C1", None), "T4": (None, "M1")}
    gaps = {(r.id_column, r.id, r.txn_month) for r in lake.read(spark, pipeline.MISSING).collect()}
    assert gaps == {("customer_id", "C9", 3), ("customer_id", "C8", 2), ("merchant_id", "M9", 3)}
    before = lake.images[FACT, DAYS[0]].path
    _load(spark, lake, DAYS[1], {**C1, "C2": ("FULL", "2024-01-01", "x")}, ["M1", "M2"])  # nobody that was missed
    assert lake.images[FACT, DAYS[0]].path == before
    _load(spark, lake, DAYS[2], {**C1, "C9": ("FULL", "2024-01-01", "x"), "C8": ("FULL", "2024-02-20", "x")}, ["M1", "M9"])
    # C8 starts after its transaction, so February stays as it was written
    assert _keys(spark, lake) == {"T1": ("C1", "M1"), "T2": ("C9", "M1"), "T3": ("C1", "M9"), "T4": (None, "M1")}
    new, *kept = lake.images[FACT, DAYS[0]].path.split("\n")
    assert new != before and [k.split("/")[-1] for k in kept] == ["txn_month=2"]
    assert before.split("/")[-1] in kept[0]
    again = pipeline.Lakehouse.open(spark, lake.root)
    assert _keys(spark, again) == _keys(spark, lake)
    _load(spark, lake, DAYS[0], C1, ["M1"], txn)  # the facts' day again: later rows still count
    assert _keys(spark, lake) == _keys(spark, again)


def test_dimensions_may_come_only_after_the_facts(spark, lake):
    _load(spark, lake, DAYS[1], C1, ["M1"])
    _load(spark, lake, DAYS[0], txn=[("T1", "C1", "M1", FEB), ("T2", "C7", "M1", FEB)])
    assert _keys(spark, lake) == {"T1": ("C1", "M1"), "T2": (None, "M1")}


def test_a_day_loaded_again_by_another_customer_feed_moves_later_keys(spark, lake):
    _load(spark, lake, DAYS[0], {**C1, "C2": ("FULL", "2024-01-01", "x")}, ["M1"])
    _load(spark, lake, DAYS[1], txn=[("T1", "C1", "M1", MARCH), ("T2", "C2", "M1", MARCH)])
    _load(spark, lake, DAYS[0], {"A0": ("BASIC", "2024-01-01", "x"), **C1, "C2": ("FULL", "2024-01-01", "x")})
    assert _keys(spark, lake) == {"T1": ("C1", "M1"), "T2": ("C2", "M1")}


def _same(a, b):
    order = sorted(a.columns)
    key = lambda rows: sorted(map(str, rows))
    return key(a.select(*order).collect()) == key(b.select(*order).collect())


def test_states_of_each_day_give_the_reports_of_all_facts(spark, lake):
    two = {**C1, "C2": ("FULL", "2024-01-01", "x")}
    _load(spark, lake, DAYS[0], two, ["M1"], [("T1", "C1", "M1", FEB), ("T2", "C2", "M1", MARCH), ("T3", "C9", "M1", FEB)])
    first = lake.images[pipeline.SPEND, DAYS[0]].path
    # C1 moves to another city within its tier and C2 to another tier: one customer is counted once a tier
    moved = {"C1": ("BASIC", "2024-01-01", "y"), "C2": ("BASIC", "2024-01-01", "x")}
    _load(spark, lake, DAYS[1], moved, ["M1"], [("T4", "C1", "M1", DAYS[1]), ("T5", "C2", "M1", DAYS[1]), ("T6", "C2", "M1", FEB)])
    assert lake.images[pipeline.SPEND, DAYS[0]].path == first  # day 1 was not read again
    for _ in range(2):
        fact, customers = lake.read(spark, FACT), lake.read(spark, "gold.dim_customer")
        spend, bitmaps = lake.read(spark, pipeline.SPEND), lake.read(spark, pipeline.TIER_CUSTOMERS)
        assert _same(states.segment_revenue(spend, customers), reports.segment_revenue(fact, customers))
        assert _same(states.kyc_point_in_time(spend, bitmaps, customers), reports.kyc_point_in_time(fact, customers))
        _load(spark, lake, DAYS[2], {**moved, "C9": ("FULL", "2024-01-01", "x")}, txn=[("T7", "C9", "M1", DAYS[2])])  # re-keys T3 of day 1
    assert lake.images[pipeline.SPEND, DAYS[0]].path != first


def test_bitmaps_hold_members_of_several_buckets(spark):
    keys = [1, 32768, 32769, 70000, 70000]
    dim = spark.createDataFrame([(k, f"C{k}", None if k == 1 else "FULL") for k in set(keys)], "customer_key long, customer_id string, kyc_tier string")
    day = lambda ks: spark.createDataFrame([(k,) for k in ks], "customer_key long")
    parts = [states.tier_bitmaps(day(ks), dim) for ks in (keys[:3], keys[2:], [])]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert {r.kyc_tier: r.members for r in states.distinct_members(both).collect()} == {None: 1, "FULL": 3}
    assert both.select(F.max(F.octet_length("members"))).first()[0] == 4096


def test_a_date_range_reads_the_folders_of_its_months(spark, lake):
    dates = ["2023-11-30", "2023-12-01", "2023-12-31", "2024-01-05", "2024-02-10", "2024-02-11", "2024-03-01", None]
    _load(spark, lake, DAYS[0], C1, ["M1"], [(f"T{i}", "C1", "M1", d) for i, d in enumerate(dates)])
    found = lake.facts_between(spark, "2023-12-02", "2024-02-10")
    assert sorted(r.transaction_id for r in found.collect()) == ["T2", "T3", "T4"]
    plan = found._jdf.queryExecution().executedPlan()
    scans = [p for p in plan.collectLeaves().mkString("\n").split("\n") if "FileScan" in p]
    assert scans and all("PartitionFilters: [" in p and "txn_year" in p.split("PartitionFilters: [")[1].split("PushedFilters")[0] for p in scans)
    folders = found.select(F.regexp_extract("_metadata.file_path", "txn_year.*/", 0)).distinct().count()
    assert folders == 3
