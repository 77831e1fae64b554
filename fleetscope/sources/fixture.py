"""Telemetry views derived from the driver's ``events`` table.

``raw_telemetry`` is the dirty input (duplicates, NULL and 999.0 temperatures,
zero speeds); ``train_telemetry`` is the loaded, de-duplicated table
(unique on ``train_id, timestamp``, first ``event_id`` wins).  Both are plain
projections of one Parquet scan, so they scale with ``events``: no shuffle
until the de-duplication, and a single scan even for the injected copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetscope.operators.dedup import keep_first

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
SCHEMAS = {"events": EVENTS_SCHEMA}
# What raw_telemetry has beside the telemetry columns: the arrival order.
RAW_EXTRA = T.StructType([T.StructField("event_id", T.LongType())])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; a declared schema skips footer-based inference on every read."""
    r = spark.read
    if name in SCHEMAS:
        r = r.schema(SCHEMAS[name])
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Projection of ``events`` onto the telemetry columns, as SQL expressions
# (parsed once on the JVM side; double literals written as 7e0 so they are
# DOUBLE, not DECIMAL).
_BASE = [
    "event_id", "user_id", "event_type", "value",
    "CAST(date_trunc('second', ts) AS TIMESTAMP_NTZ) AS ts_s",
    "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
    "CAST(round(value * 100) AS BIGINT) AS c",
    "CASE WHEN event_id % 33 = 0 THEN 0e0 ELSE least(300e0, value * 3) END AS spd",
]
_SHAPED = [
    "event_id",
    "concat('TRN-', CAST(user_id AS STRING)) AS train_id",
    "concat('TWR-', CAST((user_id + k) % 8 AS STRING)) AS cell_tower_id",
    "ts_s AS timestamp",
    "CASE WHEN event_id % 20 = 7 THEN CAST(NULL AS DOUBLE) WHEN event_id % 100 = 3 THEN 999e0 "
    "ELSE 40 + k * 3 / 7e0 END AS temp_celsius",
    "CASE WHEN event_type = 'error' AND (user_id % 10 = 0 OR event_id % 10 = 0) THEN 'CRITICAL' "
    "WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'WARNING' ELSE 'OK' END AS status",
    "spd AS speed_kmh",
    "45.3e0 + (c % 3000) / 10007e0 AS latitude",
    "9e0 + (c % 2999) / 10007e0 AS longitude",
    "greatest(-110e0, least(-40e0, -40 - (c % 60) - 3 * (event_id % 4) - spd / 31e0)) AS signal_strength_dbm",
    "CASE event_id % 4 WHEN 0 THEN 'SEG-A' WHEN 1 THEN 'SEG-B' WHEN 2 THEN 'SEG-C' ELSE 'SEG-D' END AS line_segment",
    "CASE WHEN (k * 7 + user_id) % 100 < 40 THEN '5G' WHEN (k * 7 + user_id) % 100 < 80 THEN '4G' "
    "WHEN (k * 7 + user_id) % 100 < 90 THEN '3G' WHEN (k * 7 + user_id) % 100 < 95 THEN 'EDGE' "
    "ELSE 'OFFLINE' END AS network_type",
    "5 * (value * 3 + 150 + (k - 50) * 20 / 7e0) AS power_consumption_kw",
]
# Rows with event_id % 50 = 11 arrive twice (one scan: explode of 1 or 2 copies).
_COPIES = "explode(CASE WHEN event_id % 50 = 11 THEN array(0, 1) ELSE array(0) END) AS _copy"


def shape_events(events: DataFrame) -> DataFrame:
    """Project ``events`` onto the 12 telemetry columns (+ ``event_id``)."""
    return events.selectExpr(*_BASE).selectExpr(*_SHAPED)


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty telemetry: every shaped event once, 2 % of them (``event_id % 50 = 11``) twice.

    The copies come from a generator over the same scan (``explode`` of a
    1- or 2-element array) instead of a UNION with a second scan.
    """
    shaped = shape_events(read_table(spark, sf_dir, "events").select(*EVENT_COLUMNS))
    return with_copies(shaped)


def with_copies(shaped: DataFrame) -> DataFrame:
    """Emit the rows with ``event_id % 50 = 11`` twice (one generator over the same scan, no UNION)."""
    return shaped.selectExpr("*", _COPIES).drop("_copy")


def train_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded table: unique (train_id, timestamp), lowest ``event_id`` kept."""
    return keep_first(raw_telemetry(spark, sf_dir), ["train_id", "timestamp"], ["event_id"])
