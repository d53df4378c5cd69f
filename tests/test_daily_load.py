"""Daily loads on small feeds: several days, re-runs, reopening, rejected days, quality limits."""

import datetime

import pytest
from pyspark.sql import functions as F

from paymart.operators.calendar import dim_date, dim_date_covering
from paymart.operators.keys import dense_keys
from paymart.operators.scd1 import scd1_initial, scd1_merge
from paymart.plans import gold, pipeline, reports
from paymart.schemas import RAW_COLUMNS
from paymart.sources.storage import new_table_path

DAYS = ["2024-03-01", "2024-03-02", "2024-03-03"]


def _feed(spark, source, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS[source]))


def _customers(spark, tiers):
    return _feed(spark, "customers", [(c, "n", "e", "p", "c", "s", t, "1", "a", "2024-01-01") for c, t in tiers.items()])


def _transactions(spark, ids, status="SUCCESS", day="2024-03-01", customer="C1"):
    return _feed(spark, "transactions", [(i, customer, "M1", "UPI", day, "10.00", "1.00", "0.50", status, None, "0") for i in ids])


def _first_day(spark, lake, day=DAYS[0], txn=None):
    pipeline.land(spark, lake, "customers", _customers(spark, {"C1": "BASIC", "C2": "FULL"}), day)
    pipeline.land(spark, lake, "merchants", _feed(spark, "merchants", [("M1", "m", "c", "s", "c", "s", "1", "2024-01-01")]), day)
    pipeline.land(spark, lake, "payment_methods", _feed(spark, "payment_methods", [("P1", "UPI", "u", "t", "1")]), day)
    pipeline.land(spark, lake, "transactions", txn if txn is not None else _transactions(spark, ["T1", "T2"]), day)
    return pipeline.load_day(spark, lake, day, {"customers", "merchants", "payment_methods", "transactions"})


@pytest.fixture()
def lake(spark):
    return pipeline.Lakehouse(new_table_path(spark, "lake-test"))


def _ids(spark, lake, name="gold.fact_transaction"):
    return sorted(r[0] for r in lake.read(spark, name).select("transaction_id").collect())


def test_days_add_up_and_a_repeated_day_changes_nothing(spark, lake):
    _first_day(spark, lake)
    pipeline.land(spark, lake, "transactions", _transactions(spark, ["T2", "T3"], day="2024-03-02"), DAYS[1])
    for _ in range(2):
        pipeline.load_day(spark, lake, DAYS[1], {"transactions"})
        assert _ids(spark, lake) == ["T1", "T2", "T3"]  # T2 stays with the day that brought it
    _first_day(spark, lake)  # an earlier day again
    assert _ids(spark, lake) == ["T1", "T2", "T3"]
    stored = {r.transaction_id: r.load_date for r in lake.read(spark, "silver.transactions").collect()}
    assert stored == {"T1": DAYS[0], "T2": DAYS[0], "T3": DAYS[1]}
    assert lake.rows["gold.fact_transaction"] == 3


def test_history_survives_reopening_and_closed_versions_are_not_rewritten(spark, lake):
    _first_day(spark, lake)
    keys = {r.customer_id: r.customer_key for r in lake.read(spark, "gold.dim_customer").collect()}
    for day, tier in zip(DAYS[1:], ("GOLD", "PLATINUM")):
        again = pipeline.Lakehouse.open(spark, lake.root)
        pipeline.land(spark, again, "customers", _customers(spark, {"C1": tier, "C3": "BASIC"}), day)
        pipeline.load_day(spark, again, day, {"customers"})
    found = pipeline.Lakehouse.open(spark, lake.root)
    rows = found.read(spark, "gold.dim_customer").collect()
    c1 = sorted((r.effective_start, r.effective_end, r.kyc_tier, r.is_current) for r in rows if r.customer_id == "C1")
    d = datetime.date
    assert c1 == [
        (d(2024, 1, 1), d(2024, 3, 1), "BASIC", 0), (d(2024, 3, 2), d(2024, 3, 2), "GOLD", 0), (d(2024, 3, 3), None, "PLATINUM", 1),
    ]
    assert len({r.customer_key for r in rows}) == len(rows) == 5
    assert {r.customer_key for r in rows if r.customer_id == "C1" and r.kyc_tier == "BASIC"} == {keys["C1"]}
    closed = [found.images[pipeline.CUSTOMER_PARTS[1], day].rows for day in DAYS]
    assert closed == [0, 1, 1]  # each day writes only what it closed
    pipeline.load_day(spark, found, DAYS[2], {"customers"})
    key = lambda r: (r.customer_id, r.effective_start, r.customer_key)
    assert sorted(found.read(spark, "gold.dim_customer").collect(), key=key) == sorted(rows, key=key)


def test_a_day_of_rejects_only_loads_no_rows(spark, lake):
    _first_day(spark, lake, txn=_transactions(spark, ["T1"], status="REVERSED"))
    assert _ids(spark, lake) == [] and lake.read(spark, "gold.dim_date").count() == 0
    assert lake.quality[DAYS[0]]["dq_rejects"]["invalid_status_rejects"] == 1
    pipeline.land(spark, lake, "transactions", _transactions(spark, ["T1"]), DAYS[1])
    pipeline.load_day(spark, lake, DAYS[1], {"transactions"})
    assert _ids(spark, lake) == ["T1"] and lake.read(spark, "gold.dim_date").count() == 366


def test_a_day_over_its_limit_leaves_the_warehouse_as_it_was(spark, lake):
    _first_day(spark, lake)
    pipeline.land(spark, lake, "transactions", _transactions(spark, ["T8", "T9"], customer="NOBODY"), DAYS[1])
    before = dict(lake.images)
    with pytest.raises(pipeline.DataQualityError, match="null_customer_key is 2 of 2"):
        pipeline.load_day(spark, lake, DAYS[1], {"transactions"}, fail_above={"null_customer_key": 0.5})
    assert lake.images == before and pipeline.Lakehouse.open(spark, lake.root).images == before
    pipeline.load_day(spark, lake, DAYS[1], {"transactions"}, fail_above={"null_customer_key": 1.0}, rebalance=False)
    assert _ids(spark, lake) == ["T1", "T2", "T8", "T9"]
    assert lake.quality[DAYS[1]]["fact_quality"]["null_customer_key"] == 2


def test_calendar_range_and_wild_dates(spark, lake):
    assert dim_date(spark).count() == 4748
    wild = spark.createDataFrame([("2024-05-05",), ("9999-12-31",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    wild = wild.unionByName(spark.sql("select try_cast('294247-01-01' as date) as d"))
    days = dim_date_covering(wild, "d")
    assert days.count() == 366 and days.agg(F.min("date_key"), F.max("date_key")).first() == (20240101, 20241231)
    assert dim_date_covering(wild.limit(0), "d").count() == 0
    assert dim_date_covering(wild, "d", also=("2022-02-02", "2023-01-01")).count() == 365 + 365 + 366
    _first_day(spark, lake, txn=_transactions(spark, ["T1"]).unionByName(_transactions(spark, ["T2"], day="9999-12-31")))
    assert lake.quality[DAYS[0]]["fact_quality"]["date_key_not_in_calendar"] == 1


def test_fiscal_quarter_by_month(spark):
    days = dim_date(spark, "2024-01-01", "2024-12-31").groupBy("month", "fiscal_quarter").count().collect()
    assert {r.month: r.fiscal_quarter for r in days} == {m: (m - 4) % 12 // 3 + 1 for m in range(1, 13)} and len(days) == 12


def test_report_sums_keep_cents_beyond_doubles(spark):
    big = "99999999.99"
    fact = spark.range(1_000_000).selectExpr(
        "20240101 AS date_key", "cast(id AS string) AS transaction_id", "'SUCCESS' AS txn_status", f"cast('{big}' AS decimal(10,2)) AS txn_amount",
        "cast(0.01 AS decimal(10,2)) AS platform_fee", "cast(0 AS decimal(10,2)) AS cashback_amount", "cast(0.01 AS decimal(11,2)) AS net_revenue")
    row = reports.monthly_gmv(fact, dim_date(spark, "2024-01-01", "2024-01-31")).first()
    assert str(row.gross_merchandise_value) == "99999999990000.00" and str(row.avg_transaction_value) == big
    wide = fact.withColumn("txn_amount", F.lit("92233720368547758.07").cast("decimal(28,2)")).limit(2)
    assert str(reports.monthly_gmv(wide, dim_date(spark, "2024-01-01", "2024-01-31")).first().gross_merchandise_value) == "184467440737095516.14"


def test_payment_codes_shared_by_methods_do_not_multiply_facts(spark):
    dim = spark.createDataFrame([("P2", "UPI", 2), ("P1", "UPI", 1), ("P3", "CARD", 3), ("P4", None, 4)], "method_id string, method_code string, payment_method_key int")
    assert sorted(tuple(r) for r in gold.payment_lookup(dim).collect()) == [("CARD", 3), ("UPI", 1)]
    assert [tuple(r) for r in gold.payment_code_conflicts(dim).collect()] == [("UPI", 2)]


def test_numbering_buckets_are_bounded(spark):
    rows = spark.createDataFrame([("a",)], "id string")
    for digits in (0, 6):
        with pytest.raises(ValueError):
            dense_keys(rows, "id", "k", bucket_digits=digits)


def test_type1_merge_joins_once(spark):
    cols = ["k", "id", "name", "record_hash", "updated_at"]
    src = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, name string")
    path = new_table_path(spark, "scd1-test")
    scd1_initial(src, "id", "k", ["name"], cols, "2024-01-01").write.parquet(path)
    old = spark.read.parquet(path)
    staged = []

    def stage(df):
        staged.append(df._jdf.queryExecution().optimizedPlan().toString())
        where = new_table_path(spark, "scd1-rows")
        df.write.parquet(where)
        return spark.read.schema(df.schema).parquet(where)

    merged = scd1_merge(old, src.union(spark.createDataFrame([("c", "C")], "id string, name string")), "id", "k", ["name"], cols, "2024-01-02", stage=stage)
    assert merged.count() == 3
    assert len(staged) == 1 and staged[0].count("Join FullOuter") == 1
    assert "Join FullOuter" not in merged._jdf.queryExecution().optimizedPlan().toString()


def test_null_safe_hash_reaches_the_merges(spark):
    cols = ["k", "id", "x", "y", "record_hash", "updated_at"]
    kind = "id string, x string, y string"
    old, new = spark.createDataFrame([("a", "1", None)], kind), spark.createDataFrame([("a", None, "1")], kind)
    for safe, changed in ((False, False), (True, True)):  # concat_ws skips NULLs, so the plain hash sees no change
        image = scd1_initial(old, "id", "k", ["x", "y"], cols, "2024-01-01", null_safe=safe)
        row = scd1_merge(image, new, "id", "k", ["x", "y"], cols, "2024-01-02", null_safe=safe).first()
        assert (row.y == "1") is changed


# ---- days in any order -------------------------------------------------------------


def _dims(spark, lake, day, tiers, merchants=("M1",)):
    pipeline.land(spark, lake, "customers", _customers(spark, tiers), day)
    pipeline.land(spark, lake, "merchants", _feed(spark, "merchants", [(m, f"{m} of {day}", "c", "s", "c", "s", "1", "2024-01-01") for m in merchants]), day)
    pipeline.land(spark, lake, "payment_methods", _feed(spark, "payment_methods", [("P1", "UPI", "u", "t", "1")]), day)
    return {"customers", "merchants", "payment_methods"}


FEEDS = {  # day -> customers' tiers, merchants, transactions (id, date, customer)
    DAYS[0]: ({"C1": "BASIC", "C2": "FULL"}, ("M1",), [("T1", "2024-03-01", "C1"), ("T2", "2024-02-01", "C2"), ("T6", "2024-03-01", "C2")]),
    DAYS[1]: ({"C1": "GOLD", "C3": "BASIC"}, ("M1", "M2"), [("T2", "2024-03-02", "C2"), ("T3", "2024-03-02", "C3"), ("T4", "2024-03-02", "C1")]),
    DAYS[2]: ({"C1": "BASIC", "C2": "GOLD"}, ("M2", "M3"), [("T4", "2024-03-03", "C1"), ("T5", "2024-03-03", "C1"), ("T6", "2024-01-05", "C1"), ("T7", "2023-12-05", "C9")]),
}


def _load(spark, lake, day, feeds=FEEDS):
    tiers, merchants, rows = feeds[day]
    sources = _dims(spark, lake, day, tiers, merchants)
    txn = [(i, c, merchants[-1], "UPI", d, "10.00", "1.00", "0.50", "SUCCESS", None, "0") for i, d, c in rows]
    pipeline.land(spark, lake, "transactions", _feed(spark, "transactions", txn), day)
    return pipeline.load_day(spark, lake, day, {*sources, "transactions"})


def _contents(spark, lake):
    """Versions, merchants and facts without the numbers of their keys."""
    lake = pipeline.Lakehouse.open(spark, lake.root)
    versions = lake.read(spark, "gold.dim_customer")
    merchants = lake.read(spark, "gold.dim_merchant")
    assert versions.select("customer_key").distinct().count() == versions.count()
    facts = (
        lake.read(spark, "gold.fact_transaction").join(versions, "customer_key", "left").join(merchants.withColumnRenamed("city", "m_city"), "merchant_key", "left")
        .select("transaction_id", "txn_date", "created_at", "customer_id", "kyc_tier", "effective_start", "effective_end", "merchant_id", "updated_at")
    )
    return [sorted(map(tuple, df.collect()), key=str) for df in (versions.drop("customer_key"), merchants.drop("merchant_key"), facts)] + [
        sorted(_ids(spark, lake, "silver.transactions")), lake.rows["gold.fact_transaction"]]


def test_days_from_last_to_first_are_as_in_order(spark):
    lakes = [pipeline.Lakehouse(new_table_path(spark, "lake-order")) for _ in range(2)]
    for k in range(3):
        _load(spark, lakes[0], DAYS[k])
        _load(spark, lakes[1], DAYS[2 - k])
    assert _contents(spark, lakes[1]) == _contents(spark, lakes[0])
    # of the last day's facts, the month that no earlier day touches was not written again
    first, *kept = lakes[1].images["gold.fact_transaction", DAYS[2]].path.split("\n")
    assert [p.split("/")[-2:] for p in kept] == [["txn_year=2023", "txn_month=12"]] and not kept[0].startswith(first)


def test_an_earlier_day_again_with_another_feed(spark):
    lakes = [pipeline.Lakehouse(new_table_path(spark, "lake-again")) for _ in range(2)]
    for k in range(3):
        _load(spark, lakes[0], DAYS[k])
    keys = {r.customer_id: r.customer_key for r in lakes[0].read(spark, "gold.dim_customer").where("customer_id = 'C3'").collect()}
    other = {**FEEDS, DAYS[0]: ({"C1": "GOLD", "C4": "FULL"}, ("M1", "M3"), [("T1", "2024-03-01", "C1"), ("T4", "2024-03-01", "C4")])}
    _load(spark, lakes[0], DAYS[0], other)  # T2 and T6 go to later days, T4 comes from one
    for k in range(3):
        _load(spark, lakes[1], DAYS[k], other)
    assert _contents(spark, lakes[0]) == _contents(spark, lakes[1])
    kept = lakes[0].read(spark, "gold.dim_customer").where("customer_id = 'C3'").first()
    assert keys == {"C3": kept.customer_key}  # a customer that the day does not touch keeps its key


def test_a_day_without_repeats_reads_no_earlier_id(spark, lake, monkeypatch):
    _first_day(spark, lake)
    read = []
    load = pipeline.Lakehouse._load
    monkeypatch.setattr(pipeline.Lakehouse, "_load", lambda self, s, name, days: (read.append((name, *days)), load(self, s, name, days))[1])
    pipeline.land(spark, lake, "transactions", _transactions(spark, ["T7", "T8"]), DAYS[1])
    pipeline.load_day(spark, lake, DAYS[1], {"transactions"})
    assert ("silver.transactions", DAYS[0]) not in read
    pipeline.land(spark, lake, "transactions", _transactions(spark, ["T1", "T9"]), DAYS[2])
    read.clear()
    pipeline.load_day(spark, lake, DAYS[2], {"transactions"})
    assert ("silver.transactions", DAYS[0]) in read and ("silver.transactions", DAYS[1]) not in read
    assert _ids(spark, lake) == ["T1", "T2", "T7", "T8", "T9"]


def test_filters_admit_all_stored_ids_and_few_others(spark):
    from paymart.operators.id_index import admitted, bucket_count, id_filters

    ids = spark.range(20_000).select(F.concat(F.lit("T"), "id").alias("i"))
    few = id_filters(ids, "i", bucket_count(20_000)).withColumn("of", F.lit("d"))
    assert admitted(ids, "i", few, [8]).count() == 20_000
    others = spark.range(20_000).select(F.concat(F.lit("U"), "id").alias("i"))
    assert admitted(others, "i", few, [8]).count() < 600
    assert admitted(others.limit(0), "i", few, [8]).count() == 0


def test_two_days_take_few_jobs(spark):
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    pipeline.run_pipeline(spark, "/root/testdata/sf0.001")
    assert jobs() - before <= 100


def test_a_day_landed_again_without_rows(spark, lake):
    root = f"{lake.root}/bronze"
    pipeline.land(spark, lake, "customers", _customers(spark, {"C1": "A", "C2": "B"}), DAYS[0])
    pipeline.land(spark, lake, "customers", _customers(spark, {"C1": "A"}), DAYS[1])
    pipeline.land(spark, lake, "customers", _customers(spark, {"C1": "A"}).limit(0), DAYS[0])
    assert [r.load_date for r in pipeline.read_bronze(spark, root, "customers").collect()] == [DAYS[1]]
