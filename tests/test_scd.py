import datetime


from paymart.operators import scd2
from paymart.operators.scd1 import scd1_initial, scd1_merge

D = datetime.date
TRACK1 = ["name", "cat"]
COLS1 = ["k", "id", "name", "cat", "since", "record_hash", "updated_at"]


def _src1(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, cat string, since string")


def test_scd1_merge_rules(spark):
    old = scd1_initial(_src1(spark, [("a", "A", "x", "s1"), ("b", "B", "y", "s1"), ("c", "C", "z", "s1")]),
                       "id", "k", TRACK1, COLS1, "2024-01-01")
    src = _src1(spark, [("a", "A", "x", "s2"), ("b", "B2", "y", "s2"), ("d", "D", "w", "s2")])
    new = {r.id: r for r in scd1_merge(old, src, "id", "k", TRACK1, COLS1, "2024-02-01").collect()}
    o = {r.id: r for r in old.collect()}
    assert set(new) == {"a", "b", "c", "d"}                  # c kept although missing from source
    assert new["a"] == o["a"]                                # unchanged hash: untouched (also untracked 'since')
    assert new["b"].name == "B2" and new["b"].k == o["b"].k  # changed: tracked values, same key
    assert new["b"].since == "s1"                            # untracked attribute not updated
    assert new["b"].updated_at == "2024-02-01 00:00:00"
    assert new["d"].k == 4                                   # insert after the largest key


def test_scd1_rerun_is_noop(spark):
    old = scd1_initial(_src1(spark, [("a", "A", "x", "s"), ("b", "B", "y", "s")]), "id", "k", TRACK1, COLS1, "2024-01-01")
    src = _src1(spark, [("a", "A2", "x", "s"), ("e", "E", "y", "s")])
    once = scd1_merge(old, src, "id", "k", TRACK1, COLS1, "2024-02-01")
    twice = scd1_merge(once, src, "id", "k", TRACK1, COLS1, "2024-02-01")
    assert sorted(once.collect()) == sorted(twice.collect())


TRACK2 = ["tier"]
COLS2 = ["key", "id", "tier", "created_date", "record_hash", "effective_start", "effective_end", "is_current"]


def _src2(spark, rows):
    return spark.createDataFrame(rows, "id string, tier string, created_date date")


def _merge(image, src, as_of, **kw):
    return scd2.scd2_merge(image, src, "id", "key", TRACK2, COLS2, as_of, **kw)


def _check_invariants(image):
    rows = image.collect()
    assert len({r.key for r in rows}) == len(rows)  # unique keys
    by_id = {}
    for r in rows:
        by_id.setdefault(r.id, []).append(r)
        assert r.effective_end is None or r.effective_start <= r.effective_end
    for versions in by_id.values():
        assert sum(v.is_current for v in versions) <= 1
        vs = sorted(versions, key=lambda v: v.effective_start)
        for a, b in zip(vs, vs[1:]):
            assert a.effective_end is not None and a.effective_end < b.effective_start


def test_scd2_day_two(spark):
    day1 = _src2(spark, [("a", "BASIC", D(2020, 5, 1)), ("b", "FULL", D(2021, 1, 1)), ("c", "FULL", None)])
    img = scd2.scd2_initial(day1, "id", "key", TRACK2, COLS2, "2022-01-01")
    assert {r.id: r.effective_start for r in img.collect()} == {
        "a": D(2020, 5, 1), "b": D(2021, 1, 1), "c": D(2022, 1, 1)}
    day2 = _src2(spark, [("a", "PREMIUM", D(2020, 5, 1)), ("b", "FULL", D(2021, 1, 1)), ("d", "BASIC", D(2021, 6, 1))])
    out = _merge(img, day2, "2023-03-01")
    _check_invariants(out)
    rows = sorted(out.collect(), key=lambda r: (r.id, r.effective_start))
    a_old, a_new = [r for r in rows if r.id == "a"]
    assert (a_old.is_current, a_old.effective_end, a_old.tier) == (0, D(2023, 2, 28), "BASIC")
    assert (a_new.is_current, a_new.effective_start, a_new.effective_end, a_new.tier) == (1, D(2023, 3, 1), None, "PREMIUM")
    assert [r.is_current for r in rows if r.id == "c"] == [1]            # missing from source: kept current
    d = [r for r in rows if r.id == "d"][0]
    assert d.effective_start == D(2021, 6, 1) and d.key == 5             # first seen: starts at creation
    cls = {r.id: r.change_class for r in scd2.scd2_classify(img, day2, "id", TRACK2, COLS2, "2023-03-01").collect()}
    assert cls == {"a": "changed", "b": "unchanged", "c": "missing", "d": "new"}


def test_scd2_same_day_change_replaces_in_place(spark):
    img = scd2.scd2_initial(_src2(spark, [("a", "BASIC", None)]), "id", "key", TRACK2, COLS2, "2023-03-01", initial_start="as_of")
    out = _merge(img, _src2(spark, [("a", "FULL", None)]), "2023-03-01", initial_start="as_of")
    rows = out.collect()
    assert len(rows) == 1 and rows[0].tier == "FULL" and rows[0].key == 1 and rows[0].is_current == 1
    _check_invariants(out)


def test_scd2_rerun_is_noop(spark):
    img = scd2.scd2_initial(_src2(spark, [("a", "BASIC", None), ("b", "FULL", None)]), "id", "key", TRACK2, COLS2, "2022-01-01")
    src = _src2(spark, [("a", "FULL", None), ("e", "BASIC", None)])
    once = _merge(img, src, "2023-01-01")
    twice = _merge(once, src, "2023-01-01")
    assert sorted(once.collect()) == sorted(twice.collect())
    c = scd2.scd2_counts(once).first()
    assert (c.total_rows, c.current_rows, c.historical_rows) == (4, 3, 1)
