"""Bucketed tables: what later jobs need not shuffle, and the idempotent insert into them."""

import uuid

import pytest
from pyspark.sql import functions as F
from toy import frame, row

from fleetscope.operators.dedup import keep_first
from fleetscope.operators.lag import previous_row
from fleetscope.sources import layout


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    rows = [row(train=f"T{k % 23}", minutes=k * 7 % 500, temp=float(k)) for k in range(400)]
    layout.write_bucketed(frame(spark, rows).dropDuplicates(["train_id", "timestamp"]), name, str(tmp_path / "t"), buckets=4)
    yield name
    spark.sql(f"DROP TABLE {name}")


def final(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_one_file_a_bucket(spark, table, tmp_path):
    assert len(list((tmp_path / "t").glob("part-*.parquet"))) == 4
    homes = spark.table(table).select("train_id", F.col("_metadata.file_name").alias("f"), layout.bucket_of("train_id", 4).alias("b")).distinct()
    assert homes.count() == 23 == homes.selectExpr("train_id").distinct().count()
    assert all(f"_{r.b:05d}." in r.f for r in homes.collect())


def test_lag_dedup_and_aggregate_read_the_table_in_place(spark, table):
    t = spark.table(table)
    lagged = previous_row(t, "train_id", ["timestamp"], ["temp_celsius"])
    for df in (lagged, keep_first(t, ["train_id", "timestamp"], ["temp_celsius"]), t.groupBy("train_id").agg(F.avg("temp_celsius"))):
        p = final(df)
        assert "Exchange" not in p and "Bucketed: true" in p
    plain = previous_row(t.repartition(3), "train_id", ["timestamp"], ["temp_celsius"])
    assert sorted(map(str, lagged.collect())) == sorted(map(str, plain.collect()))


def test_insert_shuffles_the_batch_only_and_is_idempotent(spark, table):
    t = spark.table(table)
    before, setting = t.count(), spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    rows = [row(train=f"T{k % 30}", minutes=k * 7 % 500, temp=-1.0) for k in range(400)]
    batch = frame(spark, [*rows, row(train="T1", minutes=9999), row(train="T1", minutes=9999, temp=3.0)], with_id=True)
    with layout._keep_buckets(spark):
        p = final(layout.new_rows(batch, table))
    stored = p[p.index("FileScan"):]
    above = [x for x in p.splitlines() if "Exchange" in x]
    assert "Bucketed: true" in stored and len(above) == 1 and "train_id" in above[0], above  # the batch, dealt out by train
    kept = {(r.train_id, r.timestamp): r.temp_celsius for r in t.collect()}
    new = layout.insert_bucketed(batch, table)
    assert new > 0 and layout.insert_bucketed(batch, table) == 0
    spark.catalog.refreshTable(table)
    after = {(r.train_id, r.timestamp): r.temp_celsius for r in spark.table(table).collect()}
    assert len(after) == spark.table(table).count() == before + new
    assert all(after[k] == v for k, v in kept.items()) and spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == setting


def test_a_hot_bucket_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "HOT_ROWS", 50)
    rows = [row(train="HOT", minutes=k) for k in range(300)] + [row(train=f"T{k}") for k in range(20)]
    with pytest.raises(ValueError, match="day-partitioned"):
        layout.write_bucketed(frame(spark, rows), "hot", str(tmp_path / "hot"), buckets=64)


def test_empty_table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    layout.write_bucketed(frame(spark, [row()]).limit(0), name, str(tmp_path / "e"), buckets=4)
    assert spark.table(name).count() == 0
    assert layout.insert_bucketed(frame(spark, [row(), row()], with_id=True), name) == 1
