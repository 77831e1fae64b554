"""BI mart: rounded telemetry with integer date/time keys, per-key deltas and quality flags.

Steps in order (the rounding comes first, so deltas are differences of
rounded values, rounded again); rounding is half-even, as in the dataframe
library the mart was defined with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.expr import date_key, seconds_between, speed_band, time_key
from fleetscope.operators.dedup import keep_first
from fleetscope.operators.lag import previous_row
from fleetscope.schema import KEYS, MART_ORDER, MART_ROUNDING, TEMP_MAX


def round_columns(df: DataFrame, spec: dict[str, int] = MART_ROUNDING, half_even: bool = True) -> DataFrame:
    """M1: round the columns named in ``spec`` (absent ones are ignored)."""
    rnd = F.bround if half_even else F.round
    return df.withColumns({c: rnd(c, n) for c, n in spec.items() if c in df.columns})


def add_keys(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """M2 + M3: DateKey (yyyymmdd INT) and TimeKey (minute of day INT)."""
    return df.withColumns({"DateKey": date_key(ts), "TimeKey": time_key(ts)})


def add_train_deltas(df: DataFrame, buckets: Sequence[str] | None = None) -> DataFrame:
    """M5 + M6: signed temperature delta and minutes since the previous reading of the train."""
    t = previous_row(df, "train_id", ["timestamp"], ["temp_celsius", "timestamp"], prefix="_pt_", buckets=buckets)
    return t.withColumns({
        "delta_temp_celsius": F.bround(F.col("temp_celsius") - F.col("_pt_temp_celsius"), 2),
        "delta_time_min": F.bround(seconds_between("_pt_timestamp", "timestamp") / F.lit(60.0), 2),
    }).drop("_pt_temp_celsius", "_pt_timestamp")


def add_tower_delta(df: DataFrame, buckets: Sequence[str] | None = None,
                    boundary_source: DataFrame | None = None) -> DataFrame:
    """M7: absolute signal delta per tower (readings at a tower ordered by time, then train)."""
    s = previous_row(df, "cell_tower_id", ["timestamp", "train_id"], ["signal_strength_dbm"],
                     prefix="_ps_", buckets=buckets, boundary_source=boundary_source)
    delta = F.bround(F.abs(F.col("signal_strength_dbm") - F.col("_ps_signal_strength_dbm")), 2)
    return s.withColumn("delta_signal_dbm", delta).drop("_ps_signal_strength_dbm")


def add_deltas(df: DataFrame, buckets: Sequence[str] | None = None) -> DataFrame:
    """M5-M7."""
    # the tower boundaries come straight from ``df`` (same rows), not from the train-lag output
    return add_tower_delta(add_train_deltas(df, buckets), buckets, boundary_source=df)


def add_quality(df: DataFrame, temp_max: float = TEMP_MAX) -> DataFrame:
    """M8 + M9: missing/extreme temperature flags (TINYINT) and the speed band (NULL speed -> NULL)."""
    missing = F.col("temp_celsius").isNull()
    return df.withColumns({
        "IsMissingTemp": F.when(missing, 1).otherwise(0).cast("tinyint"),
        "IsExtremeTemp": F.when(~missing & (F.col("temp_celsius") > temp_max), 1).otherwise(0).cast("tinyint"),
        "SpeedRange": speed_band("speed_kmh", null_to_last=False),
    })


MART_COLUMNS = ["train_id", "cell_tower_id", "temp_celsius", "status", "speed_kmh",
                "signal_strength_dbm", "line_segment", "network_type", "power_consumption_kw",
                "DateKey", "TimeKey", "delta_temp_celsius", "delta_time_min", "delta_signal_dbm",
                "IsMissingTemp", "IsExtremeTemp", "SpeedRange"]


# What the mart is computed from: its own columns, the timestamp for the keys and deltas.
MART_INPUTS = ["train_id", "timestamp", "cell_tower_id", "temp_celsius", "status", "speed_kmh", "signal_strength_dbm",
               "line_segment", "network_type", "power_consumption_kw"]


def unique_rows(raw: DataFrame, order: Sequence[str | Column] = ("event_id",),
                columns: Sequence[str] = MART_INPUTS) -> DataFrame:
    """M1-M4: rounded rows of ``columns`` with their keys, one per (train, timestamp): the first by ``order``."""
    ranks = [F.col(o) if isinstance(o, str) else o for o in order]
    narrow = raw.select(*columns, F.struct(*ranks).alias("_order"))
    return keep_first(add_keys(round_columns(narrow)), KEYS, ["_order"]).drop("_order")


def bi_mart(unique: DataFrame, buckets: Sequence[str] | None = None) -> DataFrame:
    """M5-M9 and the column order of the 17-column mart, from ``unique_rows``.

    A lazy plan.  ``unique`` feeds both lags and their boundary passes, so a
    job over a large table writes it once and passes what it reads back (the
    ``mart`` command does, into a folder it is given and removes).
    """
    return add_quality(add_deltas(unique, buckets=buckets)).select(*MART_COLUMNS)


def write_mart(mart: DataFrame, path: str, partition_by_date: bool = False) -> None:
    """M10 sink: Parquet clustered by (DateKey, train_id, TimeKey).

    ``orderBy`` range-partitions on the full clustering key (sampled bounds,
    so a busy train on one day is still split across tasks) and sorts within
    partitions; row groups then carry tight min/max statistics for the BI
    engine's date and train filters.
    """
    w = mart.orderBy(*MART_ORDER).write.mode("overwrite")
    if partition_by_date:
        w = w.partitionBy("DateKey")
    w.parquet(path)
