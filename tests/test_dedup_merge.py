import datetime as dt

import pytest
from pyspark.sql import functions as F

from geomedallion.operators.dedup import Order, dedup_by_key, first_by_key, first_per_key
from geomedallion.operators.merge import DuplicateSourceKeyError, merge_upsert

T0 = dt.datetime(2024, 1, 1)


def test_dedup_keeps_newest_then_lowest(spark):
    df = spark.createDataFrame([
        ("a", 1, T0, "z"), ("a", 1, T0 + dt.timedelta(1), "y"), ("a", 1, T0 + dt.timedelta(1), "x"),
        ("b", 2, None, "q"), ("b", 2, T0, "r"), (None, 3, T0, "n1"), (None, 3, T0, "n0"),
    ], "k string, k2 int, ts timestamp, v string")
    got = {(r.k, r.k2): r.v for r in dedup_by_key(df, ["k", "k2"], newest_first=["ts"]).collect()}
    assert got == {("a", 1): "x", ("b", 2): "r", (None, 3): "n0"}


def test_min_by_form_equals_window_form(spark):
    df = spark.range(2000).select((F.col("id") % 37).alias("k"), (F.col("id") * 7919 % 101).alias("a"),
                                  F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 13).alias("b"), "id")
    order = [Order("a", desc=True), Order("b", nulls_first=True), Order("id")]
    fast = first_by_key(df, ["k"], order)
    slow = first_per_key(df, ["k"], [o.column() for o in order])
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_dedup_output_keys_unique(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = dedup_by_key(df, ["k"], newest_first=["v"])
    assert out.count() == 3 and {r.v for r in out.collect()} == {4999, 4998, 4997}


def _tables(spark):
    target = spark.createDataFrame([(1, "a", T0), (2, "b", T0), (3, "c", T0 + dt.timedelta(days=10)), (None, "n", T0)],
                                   "k int, v string, update_tm timestamp")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (4, "D"), (None, "N")], "k int, v string")
    return target, source


def test_merge_upsert(spark):
    target, source = _tables(spark)
    run = T0 + dt.timedelta(days=30)
    out = {(r.k, r.v): r.update_tm for r in merge_upsert(target, source, ["k"], run).collect()}
    assert out == {(1, "a"): T0, (2, "B"): run, (3, "C"): run, (4, "D"): run, (None, "n"): T0, (None, "N"): run}


def test_merge_idempotent(spark):
    """merge(merge(t, s), s) == merge(t, s) for sources without null keys (null keys never
    match, so a null-keyed source row is inserted by every merge, as SQL MERGE does)."""
    target, source = _tables(spark)
    source = source.where("k IS NOT NULL")
    run = T0 + dt.timedelta(days=30)
    once = merge_upsert(target, source, ["k"], run)
    twice = merge_upsert(once, source, ["k"], run)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_merge_rejects_duplicate_source_keys(spark):
    target, _ = _tables(spark)
    dup = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(DuplicateSourceKeyError):
        merge_upsert(target, dup, ["k"], T0)


def test_merge_with_target_predicate_keeps_old_rows(spark):
    target, source = _tables(spark)
    run = T0 + dt.timedelta(days=30)
    out = merge_upsert(target, source, ["k"], run, target_predicate=F.col("update_tm") > F.lit(T0 + dt.timedelta(days=1)))
    got = sorted((r.k or 0, r.v) for r in out.collect())
    # k=2 is older than the watermark: not matched, so both rows exist; k=3 is newer: replaced
    assert got == [(0, "N"), (0, "n"), (1, "a"), (2, "B"), (2, "b"), (3, "C"), (4, "D")]
