"""Registered cleansing / enrichment queries (C1-C19) over the telemetry views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetscope.operators import cleanse as C
from fleetscope.operators.dedup import duplicate_count
from fleetscope.operators.lookup import lookup
from fleetscope.plans.catalog import register
from fleetscope.schema import COLUMNS, SIGNAL_MAX, SIGNAL_MIN, SPEED_MAX, SPEED_MIN, STATUSES, TEMP_MAX, TEMP_MIN
from fleetscope.sources.fixture import raw_telemetry, read_table, train_telemetry

# Parameters of the registered runs (seeds are salts of the row-key hash).
TRAIN_GAIN = (0.7, 1.3)
HOUR_GAIN = (0.8, 1.2)
STATUS_P = [0.95, 0.04, 0.01]
SIGNAL_JITTER = (-15, 15)
BAD_TRAINS = 15
FRAC_MISSING, FRAC_OUTLIER, FRAC_DUP, FRAC_STOP, FRAC_SAMPLE = 0.05, 0.01, 0.02, 0.03, 0.05
SALT_MISSING, SALT_OUTLIER, SALT_DUP, SALT_STOP = 101, 202, 303, 404
SALT_NOISE, SALT_STATUS, SALT_JITTER, SALT_HOUR = 606, 707, 808, 17
SALT_SAMPLE = "sample"
POWER_SCALE = 5.0
NOISE_MEAN, NOISE_SD = (SPEED_MAX - SPEED_MIN) / 2, (SPEED_MAX - SPEED_MIN) / 3

COLS = ", ".join(COLUMNS)


def _hu(key: str, salt: int) -> str:
    """SQL twin of ``hash_unit``."""
    return f"((((({key} % 100003) + 100003) % 100003) * 7919 + {salt}) % 10000) / 10000e0"


def _ku(key: str, salt: str) -> str:
    """SQL twin of ``key_unit``."""
    return f"(CAST(('0x' || substr(md5('{salt}' || {key}), 1, 8)) AS BIGINT) % 10000) / 10000e0"


def _wc(u: str, values, probs) -> str:
    """SQL twin of ``weighted_category`` (same float accumulation)."""
    parts, acc = [], 0.0
    for v, p in zip(values[:-1], probs[:-1]):
        acc += p
        parts.append(f"WHEN {u} < {acc!r} THEN '{v}'")
    return f"CASE {' '.join(parts)} ELSE '{values[-1]}' END"


def _clip(x: str, lo: float, hi: float) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest({lo!r}, least({hi!r}, {x})) END"


def _map(key: str, mapping: dict) -> str:
    """SQL twin of ``map_lookup`` (DOUBLE values: a bare 0.98 literal would be DECIMAL)."""
    whens = " ".join(f"WHEN {k!r} THEN CAST({float(v)!r} AS DOUBLE)" for k, v in mapping.items())
    return f"CASE {key} {whens} ELSE NULL END"


@register("c01_range_filter", f"SELECT {COLS} FROM raw_telemetry WHERE temp_celsius BETWEEN {TEMP_MIN!r} AND {TEMP_MAX!r}")
def c01(spark, d):
    return C.range_filter(raw_telemetry(spark, d), "temp_celsius", TEMP_MIN, TEMP_MAX).select(*COLUMNS)


@register("c02_dedup_report", """SELECT CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_out,
  CAST(sum(n) - count(*) AS BIGINT) AS duplicates_removed
FROM (SELECT count(*) AS n FROM raw_telemetry GROUP BY timestamp, train_id) g""")
def c02(spark, d):
    return duplicate_count(raw_telemetry(spark, d), ["timestamp", "train_id"])


@register("c03_clip", f"""SELECT train_id, timestamp, {_clip('temp_celsius', TEMP_MIN, TEMP_MAX)} AS temp_celsius,
  {_clip('speed_kmh', SPEED_MIN, SPEED_MAX)} AS speed_kmh FROM raw_telemetry""")
def c03(spark, d):
    t = C.clip_columns(raw_telemetry(spark, d), {"temp_celsius": (TEMP_MIN, TEMP_MAX),
                                                  "speed_kmh": (SPEED_MIN, SPEED_MAX)})
    return t.select("train_id", "timestamp", "temp_celsius", "speed_kmh")


@register("c04_train_factor", f"""SELECT train_id, timestamp, speed_modifier, speed_kmh * speed_modifier AS speed_kmh
FROM (SELECT *, {TRAIN_GAIN[0]!r} + {TRAIN_GAIN[1] - TRAIN_GAIN[0]!r} * {_ku('train_id', 'train')} AS speed_modifier
      FROM raw_telemetry) z""")
def c04(spark, d):
    t = C.scale_by_key(raw_telemetry(spark, d), "speed_kmh", "train_id", *TRAIN_GAIN, salt="train",
                       factor_name="speed_modifier")
    return t.select("train_id", "timestamp", "speed_modifier", "speed_kmh")


_HOURS = C.hour_factors(*HOUR_GAIN, salt=SALT_HOUR)


@register("c05_hour_factor", f"""SELECT train_id, timestamp, hour_noise, speed_kmh * hour_noise AS speed_kmh
FROM (SELECT *, {_map('CAST(hour(timestamp) AS INT)', _HOURS)} AS hour_noise FROM raw_telemetry) z""")
def c05(spark, d):
    t = C.scale_by_hour(raw_telemetry(spark, d), "speed_kmh", _HOURS, factor_name="hour_noise")
    return t.select("train_id", "timestamp", "hour_noise", "speed_kmh")


# Calibration in dBm of the readings of each segment.
_OFFSETS = {"SEG-A": 0.0, "SEG-B": -13.33, "SEG-C": -26.67, "SEG-D": -40.0}


@register("c06_segment_offset", f"""SELECT train_id, timestamp, signal_malus, signal_strength_dbm + signal_malus AS signal_strength_dbm
FROM (SELECT *, {_map('line_segment', _OFFSETS)} AS signal_malus FROM raw_telemetry) z""")
def c06(spark, d):
    t = C.offset_by_segment(raw_telemetry(spark, d), "signal_strength_dbm", _OFFSETS, offset_name="signal_malus")
    return t.select("train_id", "timestamp", "signal_malus", "signal_strength_dbm")


_NULLED = f"CASE WHEN {_hu('event_id', SALT_MISSING)} < {FRAC_MISSING!r} THEN NULL ELSE temp_celsius END"


@register("c07_inject_nulls", f"SELECT train_id, timestamp, {_NULLED} AS temp_celsius FROM raw_telemetry")
def c07(spark, d):
    t = C.overwrite_fraction(raw_telemetry(spark, d), "temp_celsius", None, FRAC_MISSING, "event_id", SALT_MISSING)
    return t.select("train_id", "timestamp", "temp_celsius")


@register("c08_inject_outliers", f"""SELECT train_id, timestamp,
  CASE WHEN {_hu('event_id', SALT_OUTLIER)} < {FRAC_OUTLIER!r} THEN 999e0 ELSE {_NULLED} END AS temp_celsius
FROM raw_telemetry""")
def c08(spark, d):
    t = C.overwrite_fraction(raw_telemetry(spark, d), "temp_celsius", None, FRAC_MISSING, "event_id", SALT_MISSING)
    t = C.overwrite_fraction(t, "temp_celsius", 999.0, FRAC_OUTLIER, "event_id", SALT_OUTLIER)
    return t.select("train_id", "timestamp", "temp_celsius")


@register("c09_inject_duplicates", f"""SELECT {COLS} FROM train_telemetry
UNION ALL SELECT {COLS} FROM train_telemetry WHERE {_hu('event_id', SALT_DUP)} < {FRAC_DUP!r}""")
def c09(spark, d):
    return C.inject_duplicates(train_telemetry(spark, d), FRAC_DUP, "event_id", SALT_DUP).select(*COLUMNS)


@register("c10_inject_stops", f"""SELECT train_id, timestamp,
  CASE WHEN {_hu('event_id', SALT_STOP)} < {FRAC_STOP!r} THEN 0e0 ELSE {_clip('speed_kmh', SPEED_MIN, SPEED_MAX)} END
    AS speed_kmh FROM raw_telemetry""")
def c10(spark, d):
    t = C.clip_columns(raw_telemetry(spark, d), {"speed_kmh": (SPEED_MIN, SPEED_MAX)})
    t = C.overwrite_fraction(t, "speed_kmh", 0.0, FRAC_STOP, "event_id", SALT_STOP)
    return t.select("train_id", "timestamp", "speed_kmh")


_FIRST_K = f"""SELECT train_id, min(event_id) AS first_seen FROM raw_telemetry GROUP BY train_id
ORDER BY first_seen, train_id LIMIT {BAD_TRAINS}"""


@register("c11_first_k_keys", _FIRST_K)
def c11(spark, d):
    return C.first_k_keys(raw_telemetry(spark, d), "train_id", "event_id", BAD_TRAINS)


@register("c12_override_keys", f"""SELECT train_id, timestamp,
  if(train_id IN (SELECT train_id FROM ({_FIRST_K})), 'WARNING', status) AS status FROM raw_telemetry""")
def c12(spark, d):
    raw = raw_telemetry(spark, d)
    bad = C.first_k_keys(raw, "train_id", "event_id", BAD_TRAINS)
    return C.override_for_keys(raw, bad, "train_id", "status", "WARNING").select("train_id", "timestamp", "status")


_V1 = f"(({_hu('event_id', SALT_NOISE)}) * 10000 + 1) / 10001e0"
_U2 = _hu("event_id", SALT_NOISE + 1)


@register("c13_linear_feature", f"""SELECT train_id, timestamp,
  round({POWER_SCALE!r} * (speed_kmh + ({NOISE_MEAN!r} + {NOISE_SD!r} * (sqrt(-2.0e0 * ln({_V1})) * cos({2 * 3.141592653589793!r} * {_U2})))), 6)
    AS power_consumption_kw FROM raw_telemetry""")
def c13(spark, d):
    t = C.linear_feature(raw_telemetry(spark, d), "power_consumption_kw", "speed_kmh", POWER_SCALE,
                         NOISE_MEAN, NOISE_SD, row_key="event_id", salt=SALT_NOISE)
    return t.select("train_id", "timestamp", F.round("power_consumption_kw", 6).alias("power_consumption_kw"))


@register("c14_weighted_category", f"""SELECT train_id, timestamp,
  {_wc(_hu('event_id', SALT_STATUS), STATUSES, STATUS_P)} AS status FROM raw_telemetry""")
def c14(spark, d):
    t = C.assign_category(raw_telemetry(spark, d), "status", STATUSES, STATUS_P, "event_id", SALT_STATUS)
    return t.select("train_id", "timestamp", "status")


_JIT = f"CAST(floor({_hu('event_id', SALT_JITTER)} * {SIGNAL_JITTER[1] - SIGNAL_JITTER[0]}) + {SIGNAL_JITTER[0]} AS INT)"


@register("c15_integer_jitter", f"""SELECT train_id, timestamp, signal_strength_dbm + {_JIT} AS signal_strength_dbm
FROM raw_telemetry""")
def c15(spark, d):
    t = C.add_jitter(raw_telemetry(spark, d), "signal_strength_dbm", *SIGNAL_JITTER, "event_id", SALT_JITTER)
    return t.select("train_id", "timestamp", "signal_strength_dbm")


_S1 = _clip(f"signal_strength_dbm + {_map('line_segment', _OFFSETS)} + {_JIT}", SIGNAL_MIN, SIGNAL_MAX)


@register("c16_signal_chain", f"""SELECT train_id, timestamp,
  {_clip(f'({_S1}) - speed_kmh / 10e0', SIGNAL_MIN, SIGNAL_MAX)} AS signal_strength_dbm FROM raw_telemetry""")
def c16(spark, d):
    t = C.signal_chain(raw_telemetry(spark, d), _OFFSETS, SIGNAL_JITTER, (SIGNAL_MIN, SIGNAL_MAX), 10.0,
                       "event_id", SALT_JITTER)
    return t.select("train_id", "timestamp", "signal_strength_dbm")


@register("c17_minute_spine", """SELECT unnest(generate_series(day, day + INTERVAL 1439 MINUTE, INTERVAL 1 MINUTE)) AS minute
FROM (SELECT DISTINCT CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS day FROM raw_telemetry) z""")
def c17(spark, d):
    return C.observed_minute_spine(raw_telemetry(spark, d))


@register("c17_spine_from_start", """SELECT CAST(CAST(minute AS DATE) AS VARCHAR) AS day, count(*) AS minutes, CAST(sum(readings) AS BIGINT) AS readings,
  count(*) FILTER (readings = 0) AS silent
FROM (SELECT minute, count(train_id) AS readings
  FROM (SELECT unnest(generate_series(first, first + (n - 1) * INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS minute
        FROM (SELECT CAST(date_trunc('day', min(timestamp)) AS TIMESTAMP) AS first, count(*) AS n FROM raw_telemetry) z) s
  LEFT JOIN raw_telemetry t ON date_trunc('minute', t.timestamp) = minute GROUP BY minute) per GROUP BY ALL""")
def c17_start(spark, d):
    """A minute for every reading of the table, from the first day's midnight on, and what falls into each: by day."""
    t = raw_telemetry(spark, d)
    first, n = t.agg(F.date_trunc("day", F.min("timestamp")).cast("timestamp_ntz"), F.count(F.lit(1))).first()
    per = t.groupBy(F.date_trunc("minute", "timestamp").cast("timestamp_ntz").alias("minute")).agg(F.count("train_id").alias("readings"))
    joined = C.spine(spark, first, n).join(per, "minute", "left").na.fill(0, ["readings"])
    return joined.groupBy(F.to_date("minute").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("minutes"), F.sum("readings").alias("readings"), F.count_if(F.col("readings") == 0).alias("silent"))


@register("c17_gap_report", """SELECT train_id, gap_start, gap_end, date_diff('minute', gap_start, gap_end) + 1 AS missing
FROM (SELECT train_id, lag(minute) OVER (PARTITION BY train_id ORDER BY minute) + INTERVAL 1 MINUTE AS gap_start,
    minute - INTERVAL 1 MINUTE AS gap_end
  FROM (SELECT DISTINCT train_id, CAST(date_trunc('minute', timestamp) AS TIMESTAMP) AS minute FROM raw_telemetry) s) g
WHERE gap_start <= gap_end""")
def c17_gaps(spark, d):
    return C.gap_report(raw_telemetry(spark, d))


@register("j04_dimension_lookup", """SELECT train_id, timestamp, speed_kmh, c_mktsegment, speed_kmh * (1 + c_nationkey / 100e0) AS scaled
FROM raw_telemetry LEFT JOIN (SELECT 'TRN-' || c_custkey AS id, * FROM customer WHERE c_nationkey < 20) c ON train_id = id""")
def j04(spark, d):
    """A factor and a class for each train off a dimension table that lacks some of them."""
    dim = (read_table(spark, d, "customer").filter("c_nationkey < 20")
           .select(F.concat(F.lit("TRN-"), F.col("c_custkey").cast("string")).alias("id"), "c_mktsegment", "c_nationkey"))
    found = lookup(raw_telemetry(spark, d), dim, "train_id", ["c_mktsegment", "c_nationkey"], dim_key="id")
    return found.select("train_id", "timestamp", "speed_kmh", "c_mktsegment",
                        (F.col("speed_kmh") * (1 + F.col("c_nationkey") / F.lit(100.0))).alias("scaled"))


@register("c18_canonical_order", """SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS inversions_inside,
  CAST(0 AS BIGINT) AS inversions_between FROM raw_telemetry""")
def c18(spark, d):
    """The ordered rows checked: neighbours out of order inside a partition, and partitions that begin before the last ends."""
    key = F.struct("train_id", "timestamp", "event_id")
    ordered = C.canonical_order(raw_telemetry(spark, d), tiebreak=["event_id"]).select(
        key.alias("k"), F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at"))
    near = Window.partitionBy("p", F.floor(F.col("at") / 100_000)).orderBy("at")
    parts = ordered.withColumn("bad", F.coalesce(F.lag("k").over(near) > F.col("k"), F.lit(False))).groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    beside = Window.orderBy("p")  # a row per partition
    parts = parts.withColumn("late", F.coalesce(F.lag("hi").over(beside) > F.col("lo"), F.lit(False)))
    return parts.agg(F.sum("n").alias("row_count"), F.sum("bad").alias("inversions_inside"),
                     F.count_if("late").alias("inversions_between"))


@register("c19_sample_exact", f"""SELECT {COLS} FROM raw_telemetry
QUALIFY row_number() OVER (ORDER BY CAST(('0x' || substr(md5('{SALT_SAMPLE}' || event_id), 1, 15)) AS BIGINT), event_id)
  <= (SELECT round(count(*) * {FRAC_SAMPLE!r}) FROM raw_telemetry)""")
def c19(spark, d):
    return C.sample_exact(raw_telemetry(spark, d), FRAC_SAMPLE, "event_id", SALT_SAMPLE, ["event_id"]).select(*COLUMNS)
