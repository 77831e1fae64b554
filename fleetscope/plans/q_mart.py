"""Registered mart queries (M1-M10)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetscope.plans import mart as M
from fleetscope.plans.catalog import register
from fleetscope.plans.oracle import band_sql
from fleetscope.sources.files import scratch_path
from fleetscope.sources.fixture import raw_telemetry

ROUNDED = f"""r AS (SELECT event_id, train_id, cell_tower_id, timestamp,
  round_even(temp_celsius, 2) AS temp_celsius, status, round_even(speed_kmh, 2) AS speed_kmh,
  round_even(latitude, 3) AS latitude, round_even(longitude, 3) AS longitude,
  round_even(signal_strength_dbm, 2) AS signal_strength_dbm, line_segment, network_type,
  round_even(power_consumption_kw, 2) AS power_consumption_kw FROM raw_telemetry),
kk AS (SELECT *, CAST(year(timestamp) * 10000 + month(timestamp) * 100 + day(timestamp) AS INT) AS DateKey,
  CAST(hour(timestamp) * 60 + minute(timestamp) AS INT) AS TimeKey FROM r),
dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY train_id, timestamp ORDER BY event_id) AS rn
  FROM kk) z WHERE rn = 1),
mm AS (SELECT *,
  round_even(temp_celsius - lag(temp_celsius) OVER (PARTITION BY train_id ORDER BY timestamp), 2) AS delta_temp_celsius,
  round_even((epoch(timestamp) - epoch(lag(timestamp) OVER (PARTITION BY train_id ORDER BY timestamp))) / 60e0, 2)
    AS delta_time_min,
  round_even(abs(signal_strength_dbm - lag(signal_strength_dbm) OVER (PARTITION BY cell_tower_id ORDER BY timestamp, train_id)), 2)
    AS delta_signal_dbm,
  CAST(CASE WHEN temp_celsius IS NULL THEN 1 ELSE 0 END AS TINYINT) AS IsMissingTemp,
  CAST(CASE WHEN temp_celsius IS NOT NULL AND temp_celsius > 120 THEN 1 ELSE 0 END AS TINYINT) AS IsExtremeTemp,
  {band_sql('speed_kmh', null_to_last=False)} AS SpeedRange
FROM dd)"""


def _unique(spark, d, *columns):
    """Rounded, unique rows of the columns that a step needs."""
    return M.unique_rows(raw_telemetry(spark, d), columns=["train_id", "timestamp", *columns])


def _mart(spark, d):
    return M.bi_mart(M.unique_rows(raw_telemetry(spark, d)))


@register("m01_round_columns", """SELECT train_id, timestamp, temp_celsius, speed_kmh, latitude, longitude,
  signal_strength_dbm, power_consumption_kw FROM r""", ROUNDED)
def m01(spark, d):
    return M.round_columns(raw_telemetry(spark, d)).select(
        "train_id", "timestamp", "temp_celsius", "speed_kmh", "latitude", "longitude",
        "signal_strength_dbm", "power_consumption_kw")


@register("m02_date_key", "SELECT train_id, timestamp, DateKey FROM kk", ROUNDED)
def m02(spark, d):
    return M.add_keys(raw_telemetry(spark, d)).select("train_id", "timestamp", "DateKey")


@register("m03_time_key", "SELECT train_id, timestamp, TimeKey FROM kk", ROUNDED)
def m03(spark, d):
    return M.add_keys(raw_telemetry(spark, d)).select("train_id", "timestamp", "TimeKey")


@register("m04_dedup", "SELECT * EXCLUDE (event_id) FROM dd", ROUNDED)
def m04(spark, d):
    return M.unique_rows(raw_telemetry(spark, d), columns=[*M.MART_INPUTS, "latitude", "longitude"])


@register("m05_delta_temp", "SELECT train_id, timestamp, temp_celsius, delta_temp_celsius FROM mm", ROUNDED)
def m05(spark, d):
    return M.add_train_deltas(_unique(spark, d, "temp_celsius")).select(
        "train_id", "timestamp", "temp_celsius", "delta_temp_celsius")


@register("m06_delta_time", "SELECT train_id, timestamp, delta_time_min FROM mm", ROUNDED)
def m06(spark, d):
    return M.add_train_deltas(_unique(spark, d, "temp_celsius")).select("train_id", "timestamp", "delta_time_min")


@register("m07_delta_signal", """SELECT cell_tower_id, train_id, timestamp, signal_strength_dbm, delta_signal_dbm
FROM mm""", ROUNDED)
def m07(spark, d):
    return M.add_tower_delta(_unique(spark, d, "cell_tower_id", "signal_strength_dbm")).select(
        "cell_tower_id", "train_id", "timestamp", "signal_strength_dbm", "delta_signal_dbm")


@register("m08_quality_flags", "SELECT train_id, timestamp, IsMissingTemp, IsExtremeTemp FROM mm", ROUNDED)
def m08(spark, d):
    return M.add_quality(_unique(spark, d, "temp_celsius", "speed_kmh")).select(
        "train_id", "timestamp", "IsMissingTemp", "IsExtremeTemp")


@register("m09_speed_range", "SELECT train_id, timestamp, speed_kmh, SpeedRange FROM mm", ROUNDED)
def m09(spark, d):
    return M.add_quality(_unique(spark, d, "temp_celsius", "speed_kmh")).select(
        "train_id", "timestamp", "speed_kmh", "SpeedRange")


@register("m10_bi_mart", """SELECT train_id, cell_tower_id, temp_celsius, status, speed_kmh, signal_strength_dbm,
  line_segment, network_type, power_consumption_kw, DateKey, TimeKey, delta_temp_celsius, delta_time_min,
  delta_signal_dbm, IsMissingTemp, IsExtremeTemp, SpeedRange FROM mm""", ROUNDED)
def m10(spark, d):
    return _mart(spark, d).select(*M.MART_COLUMNS)


@register("i17_mart_clustered_write", """SELECT train_id, cell_tower_id, temp_celsius, status, speed_kmh, signal_strength_dbm,
  line_segment, network_type, power_consumption_kw, DateKey, TimeKey, delta_temp_celsius, delta_time_min,
  delta_signal_dbm, IsMissingTemp, IsExtremeTemp, SpeedRange FROM mm""", ROUNDED)
def i17(spark, d):
    """The mart written clustered by (DateKey, train_id, TimeKey), partitioned by day, and read back."""
    path = scratch_path(spark, "mart")
    M.write_mart(_mart(spark, d), path, partition_by_date=True)
    return spark.read.parquet(path).select(*M.MART_COLUMNS)


@register("i17_mart_order", """SELECT DateKey, count(*) AS row_count, CAST(0 AS BIGINT) AS inversions,
  CAST(0 AS BIGINT) AS overlapping_files FROM mm GROUP BY DateKey""", ROUNDED)
def i17_order(spark, d):
    """How the written mart is clustered, per day: rows out of (train, minute) order inside their file, and files whose
    range of that key overlaps the file before."""
    path = scratch_path(spark, "mart")
    M.write_mart(_mart(spark, d), path, partition_by_date=True)
    rows = spark.read.parquet(path).select(
        "DateKey", F.struct("train_id", "TimeKey").alias("k"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"))
    # the row before by position; blocks of positions keep a window small, whatever the file's size
    near = Window.partitionBy("file", F.floor(F.col("at") / 100_000)).orderBy("at")
    flagged = rows.withColumn("bad", F.coalesce(F.lag("k").over(near) > F.col("k"), F.lit(False)))
    files = flagged.groupBy("DateKey", "file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    beside = Window.partitionBy("DateKey").orderBy("lo", "hi")
    files = files.withColumn("over", F.coalesce(F.lag("hi").over(beside) > F.col("lo"), F.lit(False)))
    return files.groupBy("DateKey").agg(
        F.sum("n").alias("row_count"), F.sum("bad").alias("inversions"), F.count_if("over").alias("overlapping_files"))
