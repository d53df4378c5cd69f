from pyspark.sql import functions as F
from pyspark.sql import Window

from paymart.operators.dedupe import dedupe_latest, total_order
from paymart.operators.keys import dense_keys


def test_dense_keys_match_global_order(spark):
    df = spark.range(0, 3000).select(F.concat(F.lit("K-"), F.col("id").cast("string")).alias("k"))
    got = dense_keys(df, "k", "key")
    w = Window.orderBy(F.substring(F.md5("k"), 1, 4), "k")
    want = df.withColumn("key", F.row_number().over(w).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_dense_keys_with_offset_and_empty_offset(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    off = spark.createDataFrame([(41,)], "m long")
    keys = sorted(r.key for r in dense_keys(df, "k", "key", offset=off).collect())
    assert keys == [42, 43, 44]
    empty = spark.createDataFrame([(None,)], "m long")
    assert sorted(r.key for r in dense_keys(df, "k", "key", offset=empty).collect()) == [1, 2, 3]


def test_dedupe_is_deterministic_and_ordered(spark):
    rows = [("t1", 5, "b"), ("t1", 7, "a"), ("t1", 7, None), ("t2", None, "x"), ("t2", 1, "y")]
    df = spark.createDataFrame(rows, "id string, v int, s string")
    out = dedupe_latest(df, ["id"], total_order(df, ["id"], ["v"]))
    assert sorted(tuple(r) for r in out.collect()) == [("t1", 7, "a"), ("t2", 1, "y")]
    # same survivor whatever the input partitioning
    out2 = dedupe_latest(df.repartition(5), ["id"], total_order(df, ["id"], ["v"]))
    assert sorted(out.collect()) == sorted(out2.collect())


def test_dedupe_plans_partial_limit_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    plan = dedupe_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
