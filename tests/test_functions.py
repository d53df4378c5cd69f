import datetime
from decimal import Decimal


from paymart.functions.casts import to_date, to_decimal, to_int
from paymart.functions.clean import initcap_trim, lower_trim, upper_trim
from paymart.functions.dates import date_key, fiscal_quarter, fiscal_year, is_weekend
from paymart.functions.hashing import record_hash
from paymart.functions.money import pct_rate, round_avg


def test_lenient_int_cast(spark):
    df = spark.createDataFrame([("12",), ("12.5",), ("-12.5",), ("abc",), ("99999999999",), (None,), ("n/a",)], "s string")
    got = [r[0] for r in df.select(to_int("s")).collect()]
    assert got == [12, 12, -12, None, None, None, None]


def test_decimal_and_date_casts(spark):
    df = spark.createDataFrame([("1.005", "1995-02-28"), ("bad", "1995-02-30"), ("123456789.99", None)], "a string, d string")
    rows = df.select(to_decimal("a").alias("a"), to_date("d").alias("d")).collect()
    assert rows[0].a == Decimal("1.01") and rows[0].d == datetime.date(1995, 2, 28)
    assert rows[1].a is None and rows[1].d is None
    assert rows[2].a is None  # overflows DECIMAL(10,2)


def test_string_cleaning(spark):
    df = spark.createDataFrame([(" new NATION_1 ", " USER1@X.COM", "\tpremium ")], "c string, e string, k string")
    r = df.select(initcap_trim("c"), lower_trim("e"), upper_trim("k")).first()
    assert r[0] == "New Nation_1"
    assert r[1] == "user1@x.com"
    assert r[2] == "\tPREMIUM"  # trim strips spaces only


def test_record_hash_null_handling(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(record_hash(["x", "y", "z"])).collect()]
    safe = [r[0] for r in df.select(record_hash(["x", "y", "z"], null_safe=True)).collect()]
    assert plain[0] == plain[1]  # concat_ws skips NULLs: compatible, collision-prone
    assert safe[0] != safe[1]


def test_half_up_money_rounding(spark):
    df = spark.createDataFrame([(Decimal("0.01"), 2), (Decimal("0.03"), 2), (Decimal("10.00"), 3)], "s decimal(20,2), n long")
    got = [str(r[0]) for r in df.select(round_avg("s", "n")).collect()]
    assert got == ["0.01", "0.02", "3.33"]  # 0.005 -> 0.01, 0.015 -> 0.02 (half up, exact decimals)
    df2 = spark.createDataFrame([(1, 8), (2, 3), (0, 5)], "f long, n long")
    assert [str(r[0]) for r in df2.select(pct_rate("f", "n")).collect()] == ["12.50", "66.67", "0.00"]


def test_calendar_expressions(spark):
    df = spark.createDataFrame([(datetime.date(2024, 3, 31),), (datetime.date(2024, 4, 6),), (None,)], "d date")
    rows = df.select(date_key("d"), fiscal_year("d"), fiscal_quarter("d"), is_weekend("d")).collect()
    assert tuple(rows[0]) == (20240331, 2023, 4, 1)
    assert tuple(rows[1]) == (20240406, 2024, 1, 1)
    assert rows[2][0] is None
