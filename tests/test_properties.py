"""Property tests: SCD2 invariants over random histories, exact rounding, dense keys."""

import datetime
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from paymart.functions.money import pct_rate, round_avg
from paymart.operators import scd2
from paymart.operators.keys import dense_keys

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
TRACK = ["tier"]
COLS = ["key", "id", "tier", "created_date", "record_hash", "effective_start", "effective_end", "is_current"]
IDS = ["a", "b", "c", "d"]

# A history: a list of (day offset >= previous, {id: tier}) snapshots.
snapshot = st.dictionaries(st.sampled_from(IDS), st.sampled_from(["BASIC", "FULL", "PREMIUM"]), min_size=1)
history = st.lists(st.tuples(st.integers(min_value=0, max_value=3), snapshot), min_size=1, max_size=4)


def _frame(spark, snap):
    rows = [(i, t, datetime.date(2020, 1, 1)) for i, t in sorted(snap.items())]
    return spark.createDataFrame(rows, "id string, tier string, created_date date")


@SETTINGS
@given(history)
def test_scd2_history_invariants(spark, hist):
    day = datetime.date(2022, 1, 1)
    image, seen, last = None, set(), {}
    for gap, snap in hist:
        day = day + datetime.timedelta(days=gap)
        src = _frame(spark, snap)
        args = ("id", "key", TRACK, COLS, day.isoformat())
        image = scd2.scd2_initial(src, *args) if image is None else scd2.scd2_merge(image, src, *args)
        image = spark.createDataFrame(image.collect(), image.schema)  # pin the image, as a stored table would be
        seen |= set(snap)
        last.update(snap)
    rows = image.collect()
    assert len({r.key for r in rows}) == len(rows)
    assert {r.id for r in rows} == seen
    for i in seen:
        versions = sorted((r for r in rows if r.id == i), key=lambda r: r.effective_start)
        assert sum(v.is_current for v in versions) == 1
        assert versions[-1].is_current == 1 and versions[-1].effective_end is None
        assert versions[-1].tier == last[i]  # the current version carries the latest known value
        for a, b in zip(versions, versions[1:]):
            assert a.effective_end is not None and a.effective_start <= a.effective_end < b.effective_start
    # loading the last snapshot again changes nothing
    again = scd2.scd2_merge(image, _frame(spark, hist[-1][1]), "id", "key", TRACK, COLS, day.isoformat())
    assert sorted(again.collect()) == sorted(rows)


def _half_up(num: int, den: int, scale: int) -> Decimal:
    return (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**13), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_money_rounding_is_exact_half_up(spark, pairs):
    rows = [(Decimal(c) / 100, n, min(c, n)) for c, n in pairs]
    df = spark.createDataFrame(rows, "s decimal(30,2), n long, f long")
    got = df.select(round_avg("s", "n").alias("avg"), pct_rate("f", "n").alias("pct")).collect()
    for (c, n), (_, _, f), r in zip(pairs, rows, got):
        assert r.avg == _half_up(c, 100 * n, 2)
        assert r.pct == _half_up(100 * f, n, 2)


@SETTINGS
@given(st.sets(st.text(alphabet="abcXYZ019-", min_size=1, max_size=6), min_size=1, max_size=60), st.integers(0, 10**6))
def test_dense_keys_equal_global_order(spark, keys, offset):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    off = spark.createDataFrame([(offset,)], "m long")
    got = dense_keys(df, "k", "key", offset=off)
    w = Window.orderBy(F.substring(F.md5("k"), 1, 4), "k")
    want = df.withColumn("key", (F.row_number().over(w) + offset).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())
