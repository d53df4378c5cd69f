"""What the jobs move: bounded landing files, a feed join and a deduplication that run once, facts that stay in their months."""

import gzip
import os

from pyspark.sql import functions as F

from paymart.operators.id_index import id_filters
from paymart.plans import pipeline
from paymart.plans.scenario import Warehouse
from paymart.sources import bronze, csv, fixtures
from paymart.sources.storage import new_table_path, read_table, write_table


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_landed_files_are_gzipped_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(csv, "ROWS_PER_FILE", 10)
    rows = spark.range(35).coalesce(1).select(*[F.concat(F.lit(f" {c},"), F.col("id").cast("string")).alias(c) for c in ("method_id", "method_code", "method_name", "method_type", "is_active")])
    path = csv.write_csv(rows, new_table_path(spark, "csv-test"))
    local = path.removeprefix("file:")
    files = [f for f in os.listdir(local) if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    assert max(len(gzip.open(f"{local}/{f}", "rt").readlines()) for f in files) == 11  # with the header
    back = csv.read_csv_strings(spark, path, "payment_methods")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_tables_are_written_with_zstd(spark):
    path = write_table(spark.range(3), new_table_path(spark, "zstd")).removeprefix("file:")
    assert [f for f in os.listdir(path) if f.startswith("part-")] and all(".zstd." in f for f in os.listdir(path) if f.startswith("part-"))


def test_digits_as_the_formatter_writes_them(spark):
    keys = spark.createDataFrame([(k,) for k in (0, 7, 9999, 10_000, 123_456_789, -5, -123_456, None)], "k long")
    for r in keys.select(fixtures._digits(F.col("k"), 4).alias("now"), F.format_string("%04d", "k").alias("was")).collect():
        assert r.now == r.was


def test_feed_join_meets_short_values(spark, sf_small):
    """Doubles and timestamps are cut before the shuffle, which does not depend on the size of orders."""
    plan = fixtures.raw_transactions(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    exchanged = [line for line in _plan(fixtures.raw_transactions(spark, sf_small)).splitlines() if "cast(l_extendedprice" in line]
    assert exchanged and all("l_orderkey" in line for line in exchanged)


def test_transactions_are_deduplicated_once(spark, sf_small):
    """Calendar, fact and counts read the stored rows; the feed is joined and deduplicated while these are written."""
    w = Warehouse(spark, sf_small)
    assert "Window" not in _plan(w.fact) and "Window" not in _plan(w.dim_date)
    assert sorted(r[0] for r in w.stored_transactions.select("transaction_id").collect()) == sorted(r[0] for r in w.transactions.select("transaction_id").collect())
    assert w.stored_transactions.dtypes == w.transactions.dtypes


def test_facts_stay_in_the_months_they_are_read_from(spark, sf_small, monkeypatch):
    plans = {}

    def spy(df, path, *args, **options):
        plans[path.split("/load_day=")[0].rsplit("/", 1)[-1]] = _plan(df)
        return write_table(df, path, *args, **options)

    monkeypatch.setattr(pipeline, "write_table", spy)
    lake = pipeline.run_pipeline(spark, sf_small)
    assert "Rebalance" not in plans["fact_transaction"]
    assert "Rebalance" in plans["transactions"]
    # a month has no more files than its transactions have, and the same rows
    image = {n: read_table(spark, lake.images[n, pipeline.DAY2].path) for n in ("silver.transactions", "gold.fact_transaction")}
    found = {}
    for name, df in image.items():
        parts = df.groupBy("txn_year", "txn_month").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col("_metadata.file_path")).alias("files"))
        found[name] = {(r.txn_year, r.txn_month): (r.n, r.files) for r in parts.collect()}
    silver, gold = found["silver.transactions"], found["gold.fact_transaction"]
    assert silver.keys() == gold.keys() and all(silver[m][0] == gold[m][0] and silver[m][1] >= gold[m][1] for m in silver)


def test_the_feed_join_moves_bits_for_its_rules(spark, sf_small):
    plan = fixtures.raw_transactions(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in line]
    assert len(exchanges) == 1
    join = _plan(fixtures.raw_transactions(spark, sf_small)).splitlines()
    [moved] = [line for line in join if "cast(l_extendedprice" in line]
    columns = moved.split("Project [")[1]
    assert " AS bits#" in columns and ", l_returnflag#" not in columns and ", l_partkey#" not in columns


def test_bronze_files_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(bronze, "ROWS_PER_FILE", 10)
    rows = spark.range(35).coalesce(1).select(*[F.concat(F.lit(f"{c}"), F.col("id").cast("string")).alias(c) for c in ("method_id", "method_code", "method_name", "method_type", "is_active")])
    landed, root = csv.write_csv(rows, new_table_path(spark, "csv-test")), new_table_path(spark, "bronze-test")
    stored = read_table(spark, f"{bronze.ingest_csv(spark, 'payment_methods', landed, root, '2020-01-01')}/load_date=2020-01-01")
    each = [r[0] for r in stored.groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n")).select("n").collect()]
    assert sum(each) == 35 and max(each) == 10


def test_ids_are_shuffled_before_their_bits_are_spread_out(spark):
    ids = spark.range(1000).select(F.concat(F.lit("T"), "id").alias("i"))
    plan = id_filters(ids, "i", 4)._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if "Exchange" in line or "Generate" in line]
    assert len(steps) == 2 and "Generate" in steps[0] and "Exchange" in steps[1]


def test_rows_of_a_later_day_are_not_written_to_meet_the_stored_ids(spark, sf_small, monkeypatch):
    """Only ids are; the anti join takes the rows as the deduplication dealt them, so they are shuffled once for both."""
    written, plans = [], []
    scratch, table = pipeline._Load.scratch, write_table
    monkeypatch.setattr(pipeline._Load, "scratch", lambda run, df: written.append(df.columns) or scratch(run, df))
    monkeypatch.setattr(pipeline, "checked_broadcast", lambda df: df.hint("merge"))

    def spy(df, path, *args, **options):
        if "/silver/transactions/" in path:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return table(df, path, *args, **options)

    monkeypatch.setattr(pipeline, "write_table", spy)
    lake = pipeline.run_pipeline(spark, sf_small, part="first")
    pipeline.land(spark, lake, "transactions", fixtures.raw_transactions(spark, sf_small, "second"), fixtures.DAY3)
    pipeline.load_day(spark, lake, fixtures.DAY3, {"transactions"})
    assert ["transaction_id"] in written and not any("txn_amount" in columns for columns in written)
    assert "LeftAnti" in plans[-1]
    by_id = [line for line in plans[-1].splitlines() if "Exchange hashpartitioning(transaction_id" in line]
    assert len(by_id) == 2  # the rows and the stored ids
    ids = [r[0] for r in lake.read(spark, "silver.transactions").select("transaction_id").collect()]
    whole = Warehouse(spark, sf_small).transactions.select("transaction_id")
    assert len(ids) == len(set(ids)) and set(ids) == {r[0] for r in whole.collect()}
