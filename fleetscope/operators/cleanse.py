"""Cleansing, calibration and seeded fault-injection operators on an existing table.

Randomness is a deterministic function of a row key (``hash_unit`` on an
integer key, ``key_unit`` on any key): independent of partitioning, identical
when a lost task is recomputed, and reproducible by the SQL oracle.  Sampling
is Bernoulli on that value (a threshold test per row, no global sort); the
exact-size sample is provided separately and explains its cost.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.functions.expr import (clip, dbl, hash_unit, hour_int, integer_jitter,
                                       key_unit, map_lookup, normal_noise, weighted_category)
from fleetscope.operators.lag import previous_row


# C1 -------------------------------------------------------------------------
def range_filter(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Keep rows with ``lo <= col <= hi`` (both inclusive); NULL is rejected."""
    return df.filter(F.col(col).between(lo, hi))


def range_reject_flag(col: str, lo: float, hi: float) -> Column:
    """TRUE for rows ``range_filter`` drops (out of range or NULL)."""
    return F.coalesce(~F.col(col).between(lo, hi), F.lit(True))


# F11 ------------------------------------------------------------------------
def drop_null_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without a NULL (or NaN) in ``cols``; all columns when None."""
    return df.dropna(how="any", subset=list(cols) if cols is not None else None)


# C3 -------------------------------------------------------------------------
def clip_columns(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """C3: clamp each named column to its (lo, hi); NULL stays NULL, row count unchanged."""
    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in bounds.items()})


# C4 / C5 / C6 ---------------------------------------------------------------
def key_factor(key: str | Column, lo: float, hi: float, salt: str) -> Column:
    """Per-key uniform factor in [lo, hi) -- e.g. one speed gain per train."""
    if not lo < hi:
        raise ValueError(f"need lo < hi, got {lo}, {hi}")
    return F.lit(lo) + F.lit(hi - lo) * key_unit(key, salt)


def scale_by_key(df: DataFrame, col: str, key: str, lo: float, hi: float, salt: str,
                 factor_name: str | None = None) -> DataFrame:
    """C4: ``col * factor(key)`` (factor kept as ``factor_name`` when given)."""
    f = key_factor(key, lo, hi, salt)
    out = df.withColumn(factor_name, f) if factor_name else df
    return out.withColumn(col, F.col(col) * (F.col(factor_name) if factor_name else f))


def hour_factors(lo: float, hi: float, salt: int) -> dict[int, float]:
    """24 hour-of-day factors in [lo, hi), from a rule (no RNG state)."""
    return {h: round(lo + (hi - lo) * (((h * 7919 + salt) % 10000) / 10000.0), 6) for h in range(24)}


def scale_by_hour(df: DataFrame, col: str, factors: dict[int, float], ts: str = "timestamp",
                  factor_name: str | None = None) -> DataFrame:
    """C5: ``col * factors[hour(ts)]`` via a literal map lookup (24 entries)."""
    f = map_lookup(hour_int(ts), factors)
    out = df.withColumn(factor_name, f) if factor_name else df
    return out.withColumn(col, F.col(col) * (F.col(factor_name) if factor_name else f))


def offset_by_segment(df: DataFrame, col: str, offsets: dict[str, float], seg: str = "line_segment",
                      offset_name: str | None = None) -> DataFrame:
    """C6: ``col + offsets[seg]`` (unknown segment -> NULL)."""
    o = map_lookup(seg, offsets)
    out = df.withColumn(offset_name, o) if offset_name else df
    return out.withColumn(col, F.col(col) + (F.col(offset_name) if offset_name else o))


# C7 / C8 / C10 / C19 --------------------------------------------------------
def sample_flag(row_key: str | Column, frac: float, salt: int) -> Column:
    """Bernoulli(frac) membership from the row key."""
    return hash_unit(row_key, salt) < dbl(frac)


def overwrite_fraction(df: DataFrame, col: str, value, frac: float, row_key: str, salt: int) -> DataFrame:
    """Set ``col`` to ``value`` (None -> NULL) on a seeded fraction of rows."""
    v = F.lit(value).cast(df.schema[col].dataType)
    return df.withColumn(col, F.when(sample_flag(row_key, frac, salt), v).otherwise(F.col(col)))


# C9 -------------------------------------------------------------------------
def inject_duplicates(df: DataFrame, frac: float, row_key: str, salt: int) -> DataFrame:
    """Append a second copy of a seeded fraction of rows (one scan: explode of 1 or 2 copies)."""
    n = F.when(sample_flag(row_key, frac, salt), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(n)).drop("_copy")


# C11 ------------------------------------------------------------------------
def first_k_keys(df: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """The first ``k`` distinct keys by first appearance (min of ``order``)."""
    firsts = df.groupBy(key).agg(F.min(order).alias("first_seen"))
    return firsts.orderBy("first_seen", key).limit(k)


# C12 ------------------------------------------------------------------------
def override_for_keys(df: DataFrame, keys: DataFrame, key: str, col: str, value) -> DataFrame:
    """Replace ``col`` by ``value`` (a Column or a constant) on rows whose ``key`` is in ``keys``.

    ``keys`` is joined as a flag table and never truncated.  Whether it is
    broadcast is the planner's choice by its size at run time.
    """
    flags = keys.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    out = df.join(flags, F.col(key) == F.col("_k"), "left")
    new = value if isinstance(value, Column) else F.lit(value)
    return out.withColumn(col, F.when(F.col("_hit"), new).otherwise(F.col(col))).drop("_k", "_hit")


# C13 ------------------------------------------------------------------------
def linear_feature(df: DataFrame, name: str, src: str, scale: float, noise_mean: float = 0.0,
                   noise_sd: float = 0.0, row_key: str | None = None, salt: int = 0) -> DataFrame:
    """``name = scale * (src + noise)``; noise is a seeded Gaussian when ``noise_sd > 0``."""
    noise = F.lit(noise_mean)
    if noise_sd > 0:
        if row_key is None:
            raise ValueError("row_key is required for seeded noise")
        noise = normal_noise(hash_unit(row_key, salt), hash_unit(row_key, salt + 1), noise_mean, noise_sd)
    return df.withColumn(name, F.lit(scale) * (F.col(src) + noise))


# C14 / C15 ------------------------------------------------------------------
def assign_category(df: DataFrame, name: str, values: Sequence[str], probs: Sequence[float],
                    row_key: str, salt: int) -> DataFrame:
    """C14: set ``name`` to a category drawn with probabilities ``probs`` (seeded by the row key)."""
    return df.withColumn(name, weighted_category(hash_unit(row_key, salt), values, probs))


def add_jitter(df: DataFrame, col: str, lo: int, hi: int, row_key: str, salt: int) -> DataFrame:
    """``col + randint(lo, hi)`` (hi exclusive)."""
    return df.withColumn(col, F.col(col) + integer_jitter(hash_unit(row_key, salt), lo, hi))


# C16 ------------------------------------------------------------------------
def signal_chain(df: DataFrame, offsets: dict[str, float], jitter: tuple[int, int], bounds: tuple[float, float],
                 speed_divisor: float, row_key: str, salt: int, col: str = "signal_strength_dbm",
                 speed: str = "speed_kmh", seg: str = "line_segment") -> DataFrame:
    """offset by segment -> integer jitter -> clip -> minus speed/divisor -> clip."""
    lo, hi = bounds
    x = F.col(col) + map_lookup(seg, offsets)
    x = x + integer_jitter(hash_unit(row_key, salt), jitter[0], jitter[1])
    x = clip(x, lo, hi)
    x = x - F.col(speed) / dbl(speed_divisor)
    return df.withColumn(col, clip(x, lo, hi))


# C17 ------------------------------------------------------------------------
def observed_minute_spine(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Every minute of every day that has at least one reading.

    Parallel by day: each distinct day expands to its 1 440 minutes, so the
    work is spread over the days instead of one row exploding a whole range.
    """
    days = df.select(F.date_trunc("day", F.col(ts)).cast("timestamp_ntz").alias("day")).distinct()
    return days.select(F.explode(F.sequence(
        F.col("day"), F.timestamp_add("MINUTE", F.lit(1439), F.col("day")),
        F.expr("INTERVAL 1 MINUTE"))).alias("minute"))


def spine(spark: SparkSession, start: datetime, periods: int, step_seconds: int = 60) -> DataFrame:
    """``minute``: ``periods`` instants from ``start``, ``step_seconds`` apart, in ascending order.

    A range of numbers turned into timestamps: made where it is used, in as many
    tasks as the session's parallelism, without a row that holds the whole.
    """
    at = F.timestamp_add("SECOND", F.col("id") * step_seconds, F.lit(start).cast("timestamp_ntz"))
    return spark.range(periods).select(at.alias("minute"))


def gap_report(df: DataFrame, key: str = "train_id", ts: str = "timestamp", step_seconds: int = 60) -> DataFrame:
    """Runs of steps without a reading, per key, between its first and its last one.

    ``key``, ``gap_start`` and ``gap_end`` (the first and the last missing step) and ``missing`` (steps).  The spine of a key is
    never written out: what it lacks is what lies between one step with a reading and the one before, by ``previous_row`` (which parts
    hot keys by time).  Readings without a timestamp are left out; a NULL key is a key.
    """
    step = F.lit(step_seconds)
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    number = F.floor(F.timestamp_diff("SECOND", zero, F.date_trunc("second", ts).cast("timestamp_ntz")) / step).cast("long")
    seen = df.filter(F.col(ts).isNotNull()).select(key, number.alias("_step")).distinct()
    seen = seen.withColumn("_at", F.timestamp_add("SECOND", F.col("_step") * step, zero))
    gaps = previous_row(seen, key, ["_at"], ["_step"], prefix="_before").filter(F.col("_step") - F.col("_before_step") > 1)
    return gaps.select(key, F.timestamp_add("SECOND", (F.col("_before_step") + 1) * step, zero).alias("gap_start"),
                       F.timestamp_add("SECOND", (F.col("_step") - 1) * step, zero).alias("gap_end"),
                       (F.col("_step") - F.col("_before_step") - 1).alias("missing"))


# C18 ------------------------------------------------------------------------
def canonical_order(df: DataFrame, by: Sequence[str] = ("train_id", "timestamp"),
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """Range-partitioned total order (sampled bounds on the full key, so a hot key is split).

    ``tiebreak`` columns settle equal keys; without them all other columns do,
    in their order, so the result is the same on every run.
    """
    rest = list(tiebreak) or [c for c in df.columns if c not in by]
    return df.orderBy(*by, *rest)


# C19 ------------------------------------------------------------------------
# Buckets of a level of the sample's histogram.
LEVEL = 4096


def row_hash(row_key: str | Column, salt: str) -> Column:
    """60 bits of ``md5(salt || key)``: a function of the key alone, the same in any engine."""
    text = F.concat(F.lit(salt), (F.col(row_key) if isinstance(row_key, str) else row_key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def sample_exact(df: DataFrame, frac: float, row_key: str, salt: str, tiebreak: Sequence[str]) -> DataFrame:
    """Exactly ``round(frac * n)`` rows: the smallest by (hash of the row key, tiebreak).

    Without a global sort.  A histogram over the top 12 bits of the hash (at
    most ``LEVEL`` rows) tells which buckets are in whole and which one holds
    the boundary; a second one over the next 12 bits splits that bucket
    again.  Only the rows of one bucket of the second level, about
    n / ``LEVEL`` ** 2, are ranked in one task.
    """
    x = df.withColumn("_h", row_hash(row_key, salt))
    x = x.withColumns({"_b1": F.shiftright("_h", 48), "_b2": F.shiftright("_h", 36) % LEVEL})
    counts = x.groupBy("_b1", "_b2").agg(F.count(F.lit(1)).alias("_c"))
    first = counts.groupBy("_b1").agg(F.sum("_c").alias("_c"))
    want = F.round(first.agg(F.sum("_c")).scalar() * F.lit(float(frac))).cast("bigint")
    upto = Window.orderBy("_b1").rowsBetween(Window.unboundedPreceding, 0)          # at most LEVEL rows
    level1 = (first.withColumn("_all", F.sum("_c").over(upto))
                   .select("_b1", "_all", (F.col("_all") - F.col("_c")).alias("_before"), want.alias("_k"))
                   .filter(F.col("_before") < F.col("_k")))
    whole1 = level1.filter(F.col("_all") <= F.col("_k")).select("_b1")
    edge = counts.join(F.broadcast(level1.filter(F.col("_all") > F.col("_k"))), "_b1")   # one bucket: at most LEVEL rows
    upto = Window.orderBy("_b2").rowsBetween(Window.unboundedPreceding, 0)
    level2 = (edge.withColumn("_all", F.col("_before") + F.sum("_c").over(upto))
                  .select("_b1", "_b2", "_all", (F.col("_all") - F.col("_c")).alias("_before"), "_k")
                  .filter(F.col("_before") < F.col("_k")))
    y1 = x.join(F.broadcast(whole1), "_b1", "left_semi")
    y2 = x.join(F.broadcast(level2), ["_b1", "_b2"])
    w = Window.partitionBy("_b1", "_b2").orderBy("_h", *tiebreak)
    part = (y2.filter(F.col("_all") > F.col("_k")).withColumn("_r", F.row_number().over(w))
              .filter(F.col("_r") <= F.col("_k") - F.col("_before")))
    whole2 = y2.filter(F.col("_all") <= F.col("_k"))
    return y1.select(*df.columns).unionByName(whole2.select(*df.columns)).unionByName(part.select(*df.columns))
