"""Lookup against a dimension table, the spine from a start, and the gap report."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from toy import frame, row

from fleetscope.operators import cleanse as C
from fleetscope.operators.lookup import DuplicateKeys, lookup


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([("A", 1), ("B", 2), (None, 3), ("Z", 4), ("A", 5), ("A", 5)], "k string, _dim_0 int")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("A", 0.5, "x"), ("B", None, "y"), (None, 9.0, "n"), (None, 8.0, "m"), ("C", 1.0, "c")], "id string, gain double, k string")


def joins(df):
    p = df._jdf.queryExecution().optimizedPlan().toString()
    return "broadcast" in p.lower()


@pytest.mark.parametrize(("limit", "small"), [(1 << 20, True), (10, False)])
def test_unknown_and_null_keys_have_null_values_and_no_row_is_lost(facts, dim, limit, small):
    got = lookup(facts, dim, "k", ["gain", "k"], dim_key="id", broadcast_bytes=limit)
    assert got.columns == ["k", "_dim_0", "gain", "k"] and joins(got) == small
    assert sorted(map(tuple, got.toDF("a", "b", "c", "d").collect()), key=str) == sorted(
        [("A", 1, 0.5, "x"), ("B", 2, None, "y"), (None, 3, None, None), ("Z", 4, None, None), ("A", 5, 0.5, "x"), ("A", 5, 0.5, "x")], key=str)


def test_duplicate_keys_are_reported(spark, facts, dim):
    with pytest.raises(DuplicateKeys, match=r"\('A',\) 2 times"):
        lookup(facts, dim.unionByName(dim.filter("id = 'A'")), "k", ["gain"], dim_key="id")


def test_several_key_columns_and_an_empty_dimension(spark):
    df = spark.createDataFrame([("A", 1), ("A", None), (None, None)], "a string, b int")
    dim = spark.createDataFrame([("A", 1, 7), ("A", None, 8)], "a string, b int, v int")
    assert sorted(map(tuple, lookup(df, dim, ["a", "b"], ["v"]).collect()), key=str) == sorted([("A", 1, 7), ("A", None, None), (None, None, None)], key=str)
    assert [r.v for r in lookup(df, dim.limit(0), ["a", "b"], ["v"]).collect()] == [None] * 3


def test_spine_from_a_start(spark):
    start = datetime(2024, 2, 28, 23, 58)
    assert [r.minute for r in C.spine(spark, start, 4).orderBy("minute").collect()] == [start + timedelta(minutes=k) for k in range(4)]
    assert [r.minute for r in C.spine(spark, start, 3, 3600).orderBy("minute").collect()] == [start + timedelta(hours=k) for k in range(3)]
    assert C.spine(spark, start, 0).count() == 0


def test_gap_report(spark):
    rows = [row(train="A", minutes=m) for m in (0, 0.5, 1, 5, 6, 2000)] + [row(train="B", minutes=3)] + [row(train="C", minutes=m) for m in (1, 2, 3)]
    df = frame(spark, rows)
    t0 = df.agg(F.min("timestamp")).first()[0].replace(second=0)
    at = lambda m: t0 + timedelta(minutes=m)
    got = sorted(map(tuple, C.gap_report(df).collect()))
    assert got == [("A", at(2), at(4), 3), ("A", at(7), at(1999), 1993)]
    nothing = df.withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    assert C.gap_report(nothing).count() == 0 and C.gap_report(df.limit(0)).count() == 0
    assert [r.missing for r in C.gap_report(df.withColumn("train_id", F.lit(None).cast("string")), step_seconds=3600).collect()] == [32]
