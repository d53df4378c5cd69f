import datetime

from pyspark.sql import functions as F

from paymart.operators.joins import as_of_join, checked_broadcast, fits, hot_keys, lookup_join

D = datetime.date


def _data(spark):
    versions = spark.createDataFrame(
        [("c1", 1, D(2020, 1, 1), D(2020, 6, 30)), ("c1", 2, D(2020, 7, 1), None), ("c2", 3, D(2021, 1, 1), None)],
        "customer_id string, customer_key int, effective_start date, effective_end date",
    )
    rows = [(f"t{i}", "c1", D(2020, 1, 1) + datetime.timedelta(days=i)) for i in range(400)]
    rows += [("u1", "c2", D(2020, 12, 31)), ("u2", "c2", D(2021, 1, 1)), ("u3", None, D(2021, 1, 1)), ("u4", "c9", D(2021, 1, 1)), ("u5", "c1", None)]
    facts = spark.createDataFrame(rows, "transaction_id string, customer_id string, txn_date date")
    return facts, versions


def _expected(facts, versions):
    out = {}
    vs = versions.collect()
    for f in facts.collect():
        match = [v.customer_key for v in vs if v.customer_id == f.customer_id and f.txn_date is not None
                 and v.effective_start <= f.txn_date and (v.effective_end is None or f.txn_date <= v.effective_end)]
        out[f.transaction_id] = match[0] if match else None
    return out


def test_as_of_join_broadcast_and_salted_paths_agree(spark):
    facts, versions = _data(spark)
    want = _expected(facts, versions)
    small = as_of_join(facts, versions, "customer_id", "txn_date")
    # every path: broadcast, shuffle without hot keys, shuffle with c1 salted over 8 sub-keys
    shuffled = as_of_join(facts, versions, "customer_id", "txn_date", max_broadcast_rows=0, hot_key_rows=10**9)
    salted = as_of_join(facts, versions, "customer_id", "txn_date", max_broadcast_rows=0, hot_key_rows=100, salt_buckets=8)
    for df in (small, shuffled, salted):
        got = {r.transaction_id: r.customer_key for r in df.collect()}
        assert got == want and df.count() == facts.count()  # grain kept, misses kept


def test_salted_plan_spreads_hot_key(spark):
    facts, versions = _data(spark)
    salted = as_of_join(facts, versions, "customer_id", "txn_date", max_broadcast_rows=0, hot_key_rows=100, salt_buckets=8)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_checked_broadcast_respects_bound(spark):
    dim = spark.range(50).withColumnRenamed("id", "k")
    fact = spark.range(10_000).select((F.col("id") % 60).alias("k"))
    small = lookup_join(fact, dim, "k", max_broadcast_rows=100)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert checked_broadcast(dim, 10) is dim  # over the bound: no hint


def test_salting_spreads_a_customer_with_a_third_of_all_facts(spark):
    """One customer owns 1/3 of the facts: with salting no reduce task gets them all."""
    hot_rows, n_cold = 3000, 300
    rows = [(f"h{i}", "HOT", D(2021, 1, 1) + datetime.timedelta(days=i % 300)) for i in range(hot_rows)]
    rows += [(f"c{i}", f"C{i % n_cold}", D(2021, 6, 1)) for i in range(2 * hot_rows)]
    facts = spark.createDataFrame(rows, "transaction_id string, customer_id string, txn_date date")
    versions = spark.createDataFrame(
        [("HOT", 1, D(2020, 1, 1), None)] + [(f"C{i}", 10 + i, D(2020, 1, 1), None) for i in range(n_cold)],
        "customer_id string, customer_key int, effective_start date, effective_end date",
    )
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)

        def biggest_task(**kw):
            out = as_of_join(facts, versions, "customer_id", "txn_date", max_broadcast_rows=0, **kw)
            sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert sum(r["count"] for r in sizes) == len(rows)
            return max(r["count"] for r in sizes)

        plain = biggest_task(hot_key_rows=10**9)
        salted = biggest_task(hot_key_rows=1000, salt_buckets=16)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plain >= hot_rows             # without salting one task holds every hot fact
    assert salted < hot_rows / 2         # with salting they spread over several tasks


def _biggest_task(spark, build, partitions=64):
    """Rows of the largest reduce task, with broadcasts and AQE off."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(partitions)}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return max(r["count"] for r in build().groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _merchant_facts(spark, hot):
    rows = spark.range(9000).select(
        F.concat(F.lit("t"), F.col("id")).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("M"), F.col("id") % 300)).alias("merchant_id"),
    )
    dim = spark.range(300).select(F.concat(F.lit("M"), F.col("id")).alias("merchant_id"), F.col("id").alias("merchant_key"))
    return rows, dim.union(spark.createDataFrame([("HOT", 999)], "merchant_id string, merchant_key long"))


def test_lookup_spreads_a_hot_merchant(spark):
    facts, dim = _merchant_facts(spark, "HOT")
    plain = _biggest_task(spark, lambda: lookup_join(facts, dim, "merchant_id", max_broadcast_rows=0, hot_key_rows=10**9))
    spread = _biggest_task(spark, lambda: lookup_join(facts, dim, "merchant_id", max_broadcast_rows=0, hot_key_rows=1000, salt_buckets=16))
    assert plain >= 3000 and spread < 1500
    out = lookup_join(facts, dim, "merchant_id", max_broadcast_rows=0, hot_key_rows=1000, salt_buckets=16)
    assert out.count() == 9000 and out.filter("merchant_key = 999").count() == 3000


def test_missing_keys_are_spread_and_kept(spark):
    facts, dim = _merchant_facts(spark, None)
    assert _biggest_task(spark, lambda: lookup_join(facts, dim, "merchant_id", max_broadcast_rows=0, hot_key_rows=10**9)) < 1000
    out = lookup_join(facts, dim, "merchant_id", max_broadcast_rows=0, hot_key_rows=10**9)
    assert out.count() == 9000 and out.filter("merchant_key is null").count() == 3000


def test_any_number_of_hot_keys_is_fine(spark):
    facts, _ = _merchant_facts(spark, "HOT")
    # 200 keys have 30 rows each, one has 3000: with at most 10 hot keys the threshold rises to 900 rows
    assert hot_keys(facts, "merchant_id", hot_key_rows=1, max_hot_keys=10).collect() == [("HOT",)]
    assert hot_keys(facts.limit(0), "merchant_id").count() == 0


def test_broadcast_bound_counts_bytes(spark):
    narrow = spark.range(1000)
    assert fits(narrow, 1000) and not fits(narrow, 999) and not fits(narrow, 1000, max_bytes=1000)
