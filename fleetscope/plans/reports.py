"""The eleven telemetry reports.

``mode="canonical"`` gives the SQL semantics (run on the de-duplicated
table); ``mode="raw"`` gives the dataframe-library semantics of the same
report (run on the raw table): integer hours, half-even rounding, ``>=`` on
the jump threshold, unrounded minutes, NULL ratio counted as efficient, all
speed bands present.  Every threshold is a keyword argument with the
original default.  Ties at a LIMIT are broken on the key columns so the
answer is deterministic.

``buckets`` (window reports): the levels of the previous-row lag (see
``operators.lag``); the answer is the same for any.  Values that the original
leaves unrounded are unrounded; ``digits`` / ``sum_digits`` round them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.expr import (blackout, hour_int, round_to, safe_div,
                                       seconds_between, speed_band)
from fleetscope.operators.aggregate import (contrast, delta_from_baseline, flag_rate,
                                            ratio_of_sums, top_k)
from fleetscope.operators.lag import previous_row
from fleetscope.schema import SPEED_LABELS

CANONICAL, RAW = "canonical", "raw"


def _check(mode: str) -> bool:
    if mode not in (CANONICAL, RAW):
        raise ValueError(f"mode must be {CANONICAL!r} or {RAW!r}, got {mode!r}")
    return mode == RAW


def _two_digit(c: str) -> Column:
    """Integer hour -> 'HH' text, applied to the (24-row) aggregate instead of every input row."""
    return F.lpad(F.col(c).cast("string"), 2, "0")


# R1 -------------------------------------------------------------------------
def hourly_speed(t: DataFrame, mode: str = CANONICAL, digits: int | None = None) -> DataFrame:
    """Average speed per hour of day (text 'HH'; int hour in raw mode)."""
    raw = _check(mode)
    agg = t.groupBy(hour_int().alias("hour")).agg(round_to(F.avg("speed_kmh"), digits).alias("avg_speed_kmh"))
    return agg if raw else agg.withColumn("hour", _two_digit("hour"))


# R2 -------------------------------------------------------------------------
def top_critical(t: DataFrame, mode: str = CANONICAL, k: int = 10, status: str = "CRITICAL") -> DataFrame:
    """Trains with most rows in ``status``, top ``k``."""
    _check(mode)
    agg = (t.filter(F.col("status") == status)
            .groupBy("train_id").agg(F.count("status").alias("critical_count")))
    return top_k(agg, [F.desc("critical_count"), F.asc("train_id")], k)


# R3 -------------------------------------------------------------------------
def signal_by_speed_band(t: DataFrame, mode: str = CANONICAL, digits: int | None = None) -> DataFrame:
    """Average signal per speed band.

    canonical: NULL speed falls into the last band, empty bands are absent.
    raw: NULL speed is dropped and all bands appear (NULL average when empty),
    via a left join from the fixed band spine; both sides have at most as many
    rows as there are bands, so the join is bounded.
    """
    raw = _check(mode)
    band = speed_band("speed_kmh", null_to_last=not raw).alias("speed_ranges")
    src = t.filter(F.col("speed_kmh").isNotNull()) if raw else t
    agg = src.groupBy(band).agg(round_to(F.avg("signal_strength_dbm"), digits).alias("avg_signal_str"))
    if not raw:
        return agg.orderBy("speed_ranges")
    spine = t.sparkSession.createDataFrame([(lab,) for lab in SPEED_LABELS], "speed_ranges string")
    return spine.join(F.broadcast(agg), "speed_ranges", "left")


# R4 -------------------------------------------------------------------------
def temp_jumps(t: DataFrame, mode: str = CANONICAL, threshold: float = 30.0, k: int = 30,
               buckets: Sequence[str] | None = None, timestamp_delta: str = "seconds") -> DataFrame:
    """Largest temperature changes between consecutive readings of a train.

    ``delta_timestamp`` is the elapsed time in seconds; ``timestamp_delta="years"``
    gives the difference of the calendar years instead (what subtracting the
    two timestamps as text yields in an engine that coerces text to its
    leading number).  canonical: ``> threshold``; raw: ``>= threshold``.
    """
    raw = _check(mode)
    if timestamp_delta not in ("seconds", "years"):
        raise ValueError("timestamp_delta must be 'seconds' or 'years'")
    src = t.select("train_id", "timestamp", "temp_celsius")
    prev = previous_row(src, "train_id", ["timestamp", "temp_celsius"], ["timestamp", "temp_celsius"],
                        prefix="previous_", buckets=buckets)
    delta = F.abs(F.col("temp_celsius") - F.col("previous_temp_celsius"))
    out = (prev.filter(F.col("previous_temp_celsius").isNotNull())
               .withColumn("delta_temp", delta)
               .filter(F.col("delta_temp") >= threshold if raw else F.col("delta_temp") > threshold)
               .withColumn("delta_timestamp", F.abs(seconds_between("previous_timestamp", "timestamp"))
                           if timestamp_delta == "seconds"
                           else F.abs(F.year("timestamp") - F.year("previous_timestamp")).cast("double")))
    out = top_k(out, [F.desc("delta_temp"), F.asc("train_id"), F.asc("timestamp")], k)
    return out.select("train_id", "delta_timestamp", "delta_temp")


# R5 -------------------------------------------------------------------------
def segment_blackout(t: DataFrame, mode: str = CANONICAL, signal_threshold: float = -100.0,
                     digits: int = 4) -> DataFrame:
    """Share of weak-signal-or-offline readings per line segment."""
    raw = _check(mode)
    return flag_rate(t, "line_segment", blackout(threshold=signal_threshold), "blackout_ratio",
                     digits, half_even=raw)


# R6 -------------------------------------------------------------------------
def power_speed_ratio(t: DataFrame, mode: str = CANONICAL, min_speed: float = 10.0, k: int = 15,
                      sum_digits: int | None = None) -> DataFrame:
    """Power-to-speed ratio of sums per train (moving above ``min_speed``), top ``k``."""
    raw = _check(mode)
    agg = ratio_of_sums(t.filter(F.col("speed_kmh") > min_speed), "train_id",
                        "power_consumption_kw", "speed_kmh", "power_sum", "speed_sum", "ratio",
                        digits=2, sum_digits=sum_digits, half_even=raw)
    return top_k(agg, [F.desc_nulls_last("ratio"), F.asc("train_id")], k)


# R7 -------------------------------------------------------------------------
def signal_drops(t: DataFrame, mode: str = CANONICAL, max_minutes: float = 5.0,
                 min_drop: float = 50.0, k: int = 15, buckets: Sequence[str] | None = None) -> DataFrame:
    """Largest signal changes between consecutive readings at one tower within a few minutes.

    canonical: the gap is rounded to whole minutes before ``< max_minutes``;
    raw: unrounded.  Readings at one tower are ordered by time, then train, then value.
    """
    raw = _check(mode)
    src = t.select("cell_tower_id", "timestamp", "train_id", "signal_strength_dbm")
    prev = previous_row(src, "cell_tower_id", ["timestamp", "train_id", "signal_strength_dbm"],
                        ["timestamp", "signal_strength_dbm"], prefix="previous_", buckets=buckets)
    minutes = seconds_between("previous_timestamp", "timestamp") / F.lit(60.0)
    if not raw:
        minutes = F.round(minutes, 0)
    out = (prev.withColumn("delta_minutes", minutes)
               .withColumn("signal_drop", F.abs(F.col("previous_signal_strength_dbm") - F.col("signal_strength_dbm")))
               .filter((F.col("delta_minutes") < max_minutes) & (F.col("signal_drop") > min_drop)))
    out = top_k(out, [F.desc("signal_drop"), F.asc("cell_tower_id"), F.asc("timestamp"), F.asc("train_id")], k)
    return out.select("cell_tower_id", "delta_minutes", "signal_drop")


# R8 -------------------------------------------------------------------------
def chronic_failure(t: DataFrame, mode: str = CANONICAL, min_share: float = 0.1, k: int = 15,
                    status: str = "CRITICAL") -> DataFrame:
    """Trains whose share of ``status`` readings exceeds ``min_share``, top ``k``."""
    _check(mode)
    agg = t.groupBy("train_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.coalesce(F.col("status") == status, F.lit(False))).alias("critical_count"))
    agg = (agg.withColumn("critical_percentage", safe_div("critical_count", "row_count"))
              .filter(F.col("critical_percentage") > min_share))
    return top_k(agg, [F.desc("critical_percentage"), F.asc("train_id")], k)


# R9 -------------------------------------------------------------------------
def speed_signal_contrast(t: DataFrame, mode: str = CANONICAL, low_max: float = 100.0,
                          high_min: float = 200.0, k: int = 15) -> DataFrame:
    """Mean signal at low (0..low_max) vs high (> high_min) speed per train, top ``k`` by difference."""
    raw = _check(mode)
    speed = F.col("speed_kmh")
    out = contrast(t, "train_id", "signal_strength_dbm", speed.between(0, low_max), speed > high_min,
                   "signal_low_speed", "signal_high_speed", "delta_signal", digits=2, round_first=raw)
    return top_k(out, [F.desc("delta_signal"), F.asc("train_id")], k)


# R10 ------------------------------------------------------------------------
def consumption_baseline(t: DataFrame, mode: str = CANONICAL, min_speed: float = 0.0, k: int = 15,
                         digits: int | None = None) -> DataFrame:
    """Per-train power/speed mean ratio against the fleet ratio, top ``k`` by mean power.

    canonical: a NULL difference is 'Inefficient' (SQL ELSE); raw: 'Efficient'.
    """
    raw = _check(mode)
    d = delta_from_baseline(t.filter(F.col("speed_kmh") > min_speed), "train_id",
                            "power_consumption_kw", "speed_kmh")
    if raw:
        status = F.when(F.col("delta") > 0, "Inefficient").otherwise("Efficient")
    else:
        status = F.when(F.col("delta") <= 0, "Efficient").otherwise("Inefficient")
    d = d.select("train_id", "avg_num", round_to("delta", digits).alias("delta_from_baseline"),
                 status.alias("efficiency_status"))
    d = top_k(d, [F.desc_nulls_last("avg_num"), F.asc("train_id")], k)
    return d.select("train_id", "delta_from_baseline", "efficiency_status")


# R11 ------------------------------------------------------------------------
def network_reliability(t: DataFrame, mode: str = CANONICAL, signal_threshold: float = -100.0,
                        digits: int = 4) -> DataFrame:
    """Share of weak-signal-or-offline readings per hour of day, worst first."""
    raw = _check(mode)
    out = flag_rate(t.withColumn("hour", hour_int()), "hour", blackout(threshold=signal_threshold),
                    "bad_signal_percentage", digits, half_even=raw)
    if not raw:
        out = out.withColumn("hour", _two_digit("hour"))
    return out.orderBy(F.desc("bad_signal_percentage"), F.asc("hour"))


REPORTS = {
    "hourly_speed": hourly_speed,
    "top_critical": top_critical,
    "signal_by_speed_band": signal_by_speed_band,
    "temp_jumps": temp_jumps,
    "segment_blackout": segment_blackout,
    "power_speed_ratio": power_speed_ratio,
    "signal_drops": signal_drops,
    "chronic_failure": chronic_failure,
    "speed_signal_contrast": speed_signal_contrast,
    "consumption_baseline": consumption_baseline,
    "network_reliability": network_reliability,
}
