"""Skew: a single hot key must not end up in a single window task."""

from pyspark.sql import functions as F

from fleetscope.operators.lag import previous_row
from fleetscope.sources.fixture import train_telemetry

SF = "/root/testdata/sf0.01"


def _largest_partition_share(df, col="previous_signal_strength_dbm"):
    # aggregate the lagged column too, or the optimizer prunes the window away
    counts = (df.groupBy(F.spark_partition_id().alias("p"))
                .agg(F.count(F.lit(1)).alias("n"), F.max(col).alias("_m")).collect())
    return max(r["n"] for r in counts) / sum(r["n"] for r in counts)


def test_hot_tower_is_split_by_multi_level_lag(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the raw partitioning visible
    try:
        t = (train_telemetry(spark, SF).select("train_id", "timestamp", "signal_strength_dbm")
             .withColumn("cell_tower_id", F.lit("TWR-HOT")))          # every reading at one tower
        plain = previous_row(t, "cell_tower_id", ["timestamp", "train_id"], ["signal_strength_dbm"],
                             buckets=())
        multi = previous_row(t, "cell_tower_id", ["timestamp", "train_id"], ["signal_strength_dbm"], hot_rows=1000)
        fine = previous_row(t, "cell_tower_id", ["timestamp", "train_id"], ["signal_strength_dbm"], buckets=("minute", "day"))
        assert _largest_partition_share(plain) == 1.0
        assert _largest_partition_share(multi) < 0.5
        assert plain.exceptAll(multi).count() == 0 and plain.exceptAll(fine).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_only_hot_keys_take_the_levelled_way(spark):
    """Two trains are hot, the others (a NULL key among them) are not; every row comes out once, as by the plain lag."""
    t = train_telemetry(spark, SF).select("train_id", "timestamp", "temp_celsius")
    hot = F.when(F.col("train_id") < "TRN-2", F.lit("A")).when(F.col("train_id") < "TRN-4", F.lit("B"))
    t = t.withColumn("train_id", F.when(F.col("train_id") == "TRN-9", F.lit(None)).otherwise(F.coalesce(hot, "train_id")))
    order = ["timestamp", "temp_celsius"]
    plain = previous_row(t, "train_id", order, ["temp_celsius"], buckets=())
    split = previous_row(t, "train_id", order, ["temp_celsius"], hot_rows=1000)
    p = split._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in p and "LeftSemi" in p and "_b1" in p
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0
    # without hot keys the plan is the plain lag: one window, no join
    few = previous_row(t, "train_id", order, ["temp_celsius"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [lag(" in few and "_b0" not in few and "Join" not in few
    nulls = previous_row(t.withColumn("train_id", F.lit(None).cast("string")), "train_id", order, ["temp_celsius"], hot_rows=1000)
    assert nulls.count() == t.count() and nulls.filter("previous_temp_celsius IS NOT NULL").count() > 0.8 * t.count()


def test_one_window_per_level(spark):
    t = train_telemetry(spark, SF).select("train_id", "timestamp", "temp_celsius")
    multi = previous_row(t, "train_id", ["timestamp"], ["temp_celsius"], buckets=("day",))
    p = multi._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in p.splitlines() if "Window [" in x and "_kk" in x]
    assert len(windows) == 3 and "unboundedfollowing" not in p  # the rows, the same shuffle read for the boundaries, one lag over the days
