"""Joins and audits along one global order, cut at hot keys."""

import datetime

import pytest
from pyspark.sql import functions as F

from paymart.operators.joins import as_of_join
from paymart.operators.ordered import as_of_join_ordered, carried_in, interval_audit, ordered_parts

D = datetime.date
VERSIONS = "customer_id string, customer_key int, effective_start date, effective_end date"


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _data(spark):
    day = lambda n: D(2020, 1, 1) + datetime.timedelta(days=n)
    versions = [("hot", i, day(30 * i), day(30 * i + 29) if i < 9 else None) for i in range(10)]
    versions += [("gap", 50, day(10), day(20)), ("gap", 51, day(40), None), ("late", 60, day(500), None), (None, 70, day(0), None), ("hot2", 80, None, None)]
    facts = [(f"h{i}", "hot", day(i % 330 - 10)) for i in range(1000)]  # some before the first version
    facts += [(f"g{i}", "gap", day(i)) for i in range(60)] + [("l", "late", day(499)), ("x", "none", day(5)), ("hot2", "hot2", day(5))]
    facts += [(f"n{i}", None, day(i % 5)) for i in range(300)] + [("d", "hot", None)] + [("twice", "hot", day(45))] * 3
    return spark.createDataFrame(facts, "transaction_id string, customer_id string, txn_date date"), spark.createDataFrame(versions, VERSIONS)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_ordered_join_equals_the_hash_join_however_it_is_cut(spark, parts):
    facts, versions = _data(spark)
    want = as_of_join(facts, versions, "customer_id", "txn_date")
    got = as_of_join_ordered(facts, versions, "customer_id", "txn_date", parts=parts)
    assert _rows(got) == _rows(want) and got.count() == facts.count()


def test_a_hot_customer_lies_in_several_parts_and_its_version_crosses_their_borders(spark):
    one = spark.createDataFrame([("c", 1, D(2020, 1, 1), None)], VERSIONS)
    facts = spark.range(4000).select(F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit("c").alias("customer_id"), F.lit(D(2020, 5, 5)).alias("txn_date"))
    got = as_of_join_ordered(facts, one, "customer_id", "txn_date", parts=8)
    assert got.where("customer_key = 1").count() == 4000
    # one key and one date: the row hash cuts them
    rows = facts.select(F.col("customer_id").alias("k"), F.xxhash64("transaction_id").alias("h"), F.lit(None).cast("int").alias("v"))
    parted = ordered_parts(rows, ["k", "h"], 8)
    sizes = [r["count"] for r in parted.groupBy("_part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2000
    assert {r["_in"] for r in carried_in(parted, ["k", "h"], "v").collect()} == {None}


def test_ordered_join_of_empty_sides(spark):
    facts, versions = _data(spark)
    assert as_of_join_ordered(facts.limit(0), versions, "customer_id", "txn_date").count() == 0
    none = as_of_join_ordered(facts, versions.limit(0), "customer_id", "txn_date")
    assert none.count() == facts.count() and none.where("customer_key IS NOT NULL").count() == 0


def _faults(rows):
    """Brute force over sorted histories."""
    out, by = [], {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for k, history in by.items():
        prev = None
        for r in sorted(history, key=lambda r: (r[2], r[1])):
            _, key, start, end, current = r
            if k is not None and prev is not None:
                if prev[3] is None or start <= prev[3]:
                    out.append((k, key, "overlap"))
                elif start > prev[3] + datetime.timedelta(days=1):
                    out.append((k, key, "gap"))
                if key <= prev[1]:
                    out.append((k, key, "key_order"))
            if end is not None and end < start:
                out.append((k, key, "reversed"))
            if (end is None) != (current == 1):
                out.append((k, key, "open_flag"))
            prev = r
    return sorted(map(str, out))


@pytest.mark.parametrize("parts", [1, 9])
def test_audit_finds_planted_faults_at_any_cut(spark, parts):
    d = lambda n: D(2020, 1, 1) + datetime.timedelta(days=n)
    rows = [("ok", 1, d(0), d(9), 0), ("ok", 2, d(10), None, 1), ("gap", 3, d(0), d(4), 0), ("gap", 4, d(10), None, 1)]
    rows += [("over", 5, d(0), d(10), 0), ("over", 6, d(10), None, 1), ("open", 7, d(0), None, 1), ("open", 8, d(5), None, 1)]
    rows += [("keys", 10, d(0), d(4), 0), ("keys", 9, d(5), None, 1), ("rev", 11, d(9), d(1), 0), ("flag", 12, d(0), d(3), 1), (None, 13, d(0), None, 1), (None, 14, d(0), None, 1)]
    rows += [("hot", 100 + i, d(2 * i), d(2 * i + (2 if i % 50 == 7 else 1)), 0) for i in range(400)]
    df = spark.createDataFrame(rows, VERSIONS + ", is_current int")
    got = interval_audit(df, "customer_id", "customer_key", parts=parts).collect()
    assert sorted(str((r.customer_id, r.customer_key, r.fault)) for r in got) == _faults(rows)
    assert interval_audit(df.limit(0), "customer_id", "customer_key").count() == 0
    assert interval_audit(df.where("customer_id = 'ok'"), "customer_id", "customer_key").count() == 0
