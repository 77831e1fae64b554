"""Telemetry data model: schema, column order and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's for equal results)
# ---------------------------------------------------------------------------
# Loaded-table column order (12 columns).
COLUMNS = [
    "train_id", "timestamp", "temp_celsius", "status",
    "speed_kmh", "latitude", "longitude", "signal_strength_dbm",
    "cell_tower_id", "power_consumption_kw", "network_type", "line_segment",
]
# Unique key of the loaded table.
KEYS = ["train_id", "timestamp"]
# Speed bands: upper-inclusive edges and labels (last band takes the rest).
SPEED_EDGES = [50, 100, 150, 200, 250]
SPEED_LABELS = ["01: 0-50", "02: 50-100", "03: 100-150",
                "04: 150-200", "05: 200-250", "06: 250-300"]
# Mart rounding: column -> digits.
MART_ROUNDING = {
    "temp_celsius": 2, "speed_kmh": 2, "latitude": 3, "longitude": 3,
    "signal_strength_dbm": 2, "power_consumption_kw": 2,
    "speed_modifier": 2, "hour_noise": 2, "signal_malus": 2,
}
# Mart: columns dropped before the write.
MART_DROP = ["timestamp", "latitude", "longitude",
             "speed_modifier", "hour_noise", "signal_malus"]
# Mart clustered write order.
MART_ORDER = ["DateKey", "train_id", "TimeKey"]
# Domain thresholds.
TEMP_MIN, TEMP_MAX = 0.0, 120.0
SPEED_MIN, SPEED_MAX = 0.0, 300.0
SIGNAL_MIN, SIGNAL_MAX = -110.0, -40.0
STATUSES = ["OK", "WARNING", "CRITICAL"]
NETWORKS = ["5G", "4G", "3G", "EDGE", "OFFLINE"]
# ---------------------------------------------------------------------------

TELEMETRY = T.StructType([
    T.StructField("train_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("temp_celsius", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("speed_kmh", T.DoubleType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    # Declared INTEGER upstream but fractional in practice: keep it double.
    T.StructField("signal_strength_dbm", T.DoubleType(), True),
    T.StructField("cell_tower_id", T.StringType(), True),
    T.StructField("power_consumption_kw", T.DoubleType(), True),
    T.StructField("network_type", T.StringType(), True),
    T.StructField("line_segment", T.StringType(), True),
])

DOUBLE_COLUMNS = [f.name for f in TELEMETRY.fields if isinstance(f.dataType, T.DoubleType)]
