import pytest
from pyspark.sql import functions as F

from paymart.schemas import RAW_COLUMNS
from paymart.sources.bronze import ingest_csv, read_bronze, read_quarantine
from paymart.sources.csv import read_csv_strings, write_csv
from paymart.sources.storage import new_table_path, storage_root


def test_storage_root_comes_from_session(spark):
    want = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert storage_root(spark) == want.rstrip("/")


def test_csv_landing_keeps_text_exactly(spark):
    cols = RAW_COLUMNS["payment_methods"]
    rows = [(" PM-1", " upi", "U,P I", "  x ", None), ("PM-2", "", "a\"b", "y", "1")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    path = write_csv(df, new_table_path(spark, "csv-test"))
    back = sorted(tuple(r) for r in read_csv_strings(spark, path, "payment_methods").collect())
    # spaces, separators and quotes survive; an empty string reads back as NULL
    assert back == sorted([(" PM-1", " upi", "U,P I", "  x ", None), ("PM-2", None, "a\"b", "y", "1")])


def test_partitioned_ingest_is_idempotent_per_day(spark):
    cols = RAW_COLUMNS["payment_methods"]
    df = spark.createDataFrame([("PM-1", "upi", "UPI", "instant", "1")], ", ".join(f"{c} string" for c in cols))
    csv = write_csv(df, new_table_path(spark, "csv-test"))
    root = new_table_path(spark, "bronze-test")
    for day in ["2024-01-01", "2024-01-02", "2024-01-01"]:
        ingest_csv(spark, "payment_methods", csv, root, day)
    b = read_bronze(spark, root, "payment_methods")
    counts = {r.load_date: r["count"] for r in b.groupBy("load_date").count().collect()}
    assert counts == {"2024-01-01": 1, "2024-01-02": 1}  # re-run replaced its own day only
    assert dict(b.dtypes)["load_date"] == "string"
    one = read_bronze(spark, root, "payment_methods", "2024-01-02")
    assert "PartitionFilters: [isnotnull(load_date" in one._jdf.queryExecution().executedPlan().toString()
    assert one.filter(F.col("source_file") == "payment_methods.csv").count() == 1


def test_stream_landing_is_exactly_once(spark):
    from paymart.streaming import stream_landing_to_bronze

    cols = RAW_COLUMNS["payment_methods"]
    df = spark.createDataFrame([("PM-1", "upi", "UPI", "instant", "1"), ("PM-2", "bnpl", "BNPL", "deferred", None)],
                               ", ".join(f"{c} string" for c in cols))
    root = new_table_path(spark, "stream-test")
    args = (spark, "payment_methods", f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    write_csv(df, f"{root}/landing/load_date=2024-01-01")
    stream_landing_to_bronze(*args).awaitTermination()
    write_csv(df.limit(1), f"{root}/landing/load_date=2024-01-02")
    stream_landing_to_bronze(*args).awaitTermination()
    stream_landing_to_bronze(*args).awaitTermination()  # nothing new: nothing added
    b = read_bronze(spark, f"{root}/bronze", "payment_methods")
    counts = {r.load_date: r["count"] for r in b.groupBy(F.col("load_date").cast("string").alias("load_date")).count().collect()}
    assert counts == {"2024-01-01": 2, "2024-01-02": 1}
    assert b.filter(F.col("load_timestamp") == "2024-01-02 00:00:00").count() == 1


def test_columns_go_by_header_name(spark):
    raw = spark.createDataFrame([("UPI", "PM-1", "x", "upi", "1", "instant")], "method_name string, method_id string, extra string, method_code string, is_active string, method_type string")
    path = write_csv(raw, new_table_path(spark, "csv-test"))
    got = read_csv_strings(spark, path, "payment_methods").collect()
    assert [tuple(r) for r in got] == [("PM-1", "upi", "UPI", "instant", "1")]
    with pytest.raises(ValueError, match="method_code"):
        read_csv_strings(spark, write_csv(raw.drop("method_code"), new_table_path(spark, "csv-test")), "payment_methods")


def test_files_of_one_landing_must_agree(spark):
    one = spark.createDataFrame([("PM-1", "upi", "UPI", "instant", "1")], ", ".join(f"{c} string" for c in RAW_COLUMNS["payment_methods"]))
    path = new_table_path(spark, "csv-test")
    one.coalesce(1).write.option("header", True).csv(path)
    one.select(*reversed(one.columns)).coalesce(1).write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_strings(spark, path, "payment_methods").collect()


def _land_lines(spark, lines):
    path = new_table_path(spark, "csv-test")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


def test_malformed_lines_are_quarantined(spark):
    head = ",".join(RAW_COLUMNS["payment_methods"])
    lines = [head, "PM-1,upi,UPI,instant,1", "PM-2,upi", "PM-3,a,b,c,d,e,f", 'PM-4,"x,y",UPI,instant,1', '"PM-5,upi,UPI,instant,1', ",,,,", "", 'PM-6,"a,b",c']
    root = new_table_path(spark, "bronze-test")
    ingest_csv(spark, "payment_methods", _land_lines(spark, lines), root, "2024-01-01")
    good = read_bronze(spark, root, "payment_methods").collect()
    assert sorted((r.method_id or "", r.method_code or "") for r in good) == [("", ""), ("PM-1", "upi"), ("PM-4", "x,y")]
    bad = {r.line: (r.reason, r.found_fields, r.expected_fields) for r in read_quarantine(spark, root, "payment_methods").collect()}
    assert bad == {
        "PM-2,upi": ("short", 2, 5), "PM-3,a,b,c,d,e,f": ("long", 7, 5),
        '"PM-5,upi,UPI,instant,1': ("short", 1, 5), 'PM-6,"a,b",c': ("short", 3, 5),
    }
    one = read_quarantine(spark, root, "payment_methods").first()
    assert one.landed_file.startswith("part-") and one.load_date == "2024-01-01" and one.source == "payment_methods"


def test_quarantine_of_a_day_is_replaced_with_the_day(spark):
    head, root = ",".join(RAW_COLUMNS["payment_methods"]), new_table_path(spark, "bronze-test")
    assert read_quarantine(spark, root, "payment_methods").count() == 0
    faulty, clean = _land_lines(spark, [head, "PM-1"]), _land_lines(spark, [head, "PM-1,upi,UPI,instant,1"])
    for day, path in (("2024-01-01", faulty), ("2024-01-02", faulty), ("2024-01-01", clean)):
        ingest_csv(spark, "payment_methods", path, root, day)
    assert [r.load_date for r in read_quarantine(spark, root, "payment_methods").collect()] == ["2024-01-02"]
    assert read_quarantine(spark, root, "payment_methods", "2024-01-01").count() == 0
    assert read_bronze(spark, root, "payment_methods").count() == 1


def test_columns_beyond_the_declared_count_as_fields(spark):
    head, root = ",".join([*RAW_COLUMNS["payment_methods"], "extra"]), new_table_path(spark, "bronze-test")
    ingest_csv(spark, "payment_methods", _land_lines(spark, [head, "PM-1,upi,UPI,instant,1,x", "PM-2,upi,UPI,instant,1"]), root, "2024-01-01")
    assert [r.method_id for r in read_bronze(spark, root, "payment_methods").collect()] == ["PM-1"]
    assert [(r.reason, r.found_fields, r.expected_fields) for r in read_quarantine(spark, root, "payment_methods").collect()] == [("short", 5, 6)]


def test_known_columns_are_held_against_the_header(spark):
    cols, root = RAW_COLUMNS["payment_methods"], new_table_path(spark, "bronze-test")
    path = _land_lines(spark, [",".join(cols), "PM-1,upi,UPI,instant,1"])
    ingest_csv(spark, "payment_methods", path, root, "2024-01-01", cols)
    assert read_bronze(spark, root, "payment_methods").count() == 1
    with pytest.raises(Exception, match="(?i)header"):
        ingest_csv(spark, "payment_methods", path, root, "2024-01-01", cols[::-1])
