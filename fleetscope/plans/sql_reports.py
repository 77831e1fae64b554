"""Reports as Spark SQL text over a temp view (I15).

``run_named(spark, name, table, **params)`` registers ``table`` as the view
``telemetry`` and runs the named statement with named parameter markers
(``:min_share`` ...), so thresholds are bound values, not string
formatting.  The statements are ordinary Spark SQL: the same optimizer,
pushdown and partial aggregation as the DataFrame forms.  Spark does not
accept a SELECT alias inside WHERE, so filters on computed values sit in an
outer query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetscope.schema import SPEED_EDGES, SPEED_LABELS

_BANDS = " ".join(f"WHEN speed_kmh <= {e} THEN '{label}'" for e, label in zip(SPEED_EDGES, SPEED_LABELS))
_WEAK = "coalesce(signal_strength_dbm < :signal, false) OR coalesce(network_type = 'OFFLINE', false)"


def _before(key: str, order: str, cols: dict[str, str]) -> str:
    """``telemetry`` with the columns of the reading before under new names.

    Readings are numbered inside (key, day); the first of a day takes the last
    of the key's day before, from a table of one row per key and day, so no
    task sorts more than a day of one key.
    """
    taken = ", ".join(f"'{new}', {old}" for old, new in cols.items())
    got = ", ".join(f"coalesce(near, far).{new} AS {new}" for new in cols.values())
    return f"""
        days AS (
          SELECT {key}, to_date(timestamp) AS day, max_by(named_struct({taken}), struct({order})) AS last
          FROM telemetry GROUP BY ALL),
        carried AS (
          SELECT {key}, day, lag(last) OVER (PARTITION BY {key} ORDER BY day) AS far FROM days),
        stepped AS (
          SELECT *, to_date(timestamp) AS day,
                 lag(named_struct({taken})) OVER (PARTITION BY {key}, to_date(timestamp) ORDER BY {order}) AS near
          FROM telemetry),
        before AS (
          SELECT s.*, {got} FROM stepped s JOIN carried c ON s.{key} <=> c.{key} AND s.day <=> c.day)"""


# name: statement and default parameters.  A NULL :digits leaves a value unrounded.
SQL_REPORTS: dict[str, tuple[str, dict]] = {
    "hourly_speed": ("""
        SELECT lpad(CAST(hour(timestamp) AS STRING), 2, '0') AS hour, {avg_speed_kmh}
        FROM telemetry GROUP BY hour(timestamp)""", {"digits": None}),
    "top_critical": ("""
        SELECT train_id, count(*) AS critical_count FROM telemetry
        WHERE status = :status GROUP BY train_id ORDER BY critical_count DESC, train_id LIMIT 10""", {"status": "CRITICAL"}),
    "signal_by_speed_band": (f"""
        SELECT CASE {_BANDS} ELSE '{SPEED_LABELS[-1]}' END AS speed_ranges, {{avg_signal_str}}
        FROM telemetry GROUP BY 1 ORDER BY speed_ranges""", {"digits": None}),
    "temp_jumps": (f"""
        WITH {_before("train_id", "timestamp, temp_celsius", {"timestamp": "t0", "temp_celsius": "c0"})}
        SELECT train_id, abs(unix_micros(CAST(timestamp AS TIMESTAMP)) - unix_micros(CAST(t0 AS TIMESTAMP))) / 1e6D AS delta_timestamp,
               abs(temp_celsius - c0) AS delta_temp
        FROM before WHERE abs(temp_celsius - c0) > :jump
        ORDER BY delta_temp DESC, train_id, timestamp LIMIT 30""", {"jump": 30.0}),
    "segment_blackout": (f"""
        SELECT line_segment, round(avg(CAST(CAST({_WEAK} AS INT) AS DOUBLE)), 4) AS blackout_ratio
        FROM telemetry GROUP BY line_segment""", {"signal": -100.0}),
    "power_speed_ratio": ("""
        SELECT train_id, {power_sum}, {speed_sum},
               round(sum(power_consumption_kw) / nullif(sum(speed_kmh), 0D), 2) AS ratio
        FROM telemetry WHERE speed_kmh > :min_speed GROUP BY train_id
        ORDER BY ratio DESC NULLS LAST, train_id LIMIT 15""", {"min_speed": 10.0, "digits": None}),
    "signal_drops": (f"""
        WITH {_before("cell_tower_id", "timestamp, train_id, signal_strength_dbm", {"timestamp": "t0", "signal_strength_dbm": "s0"})},
        gaps AS (
          SELECT *, round((unix_micros(CAST(timestamp AS TIMESTAMP)) - unix_micros(CAST(t0 AS TIMESTAMP))) / 6e7D, 0) AS delta_minutes,
                 abs(s0 - signal_strength_dbm) AS signal_drop FROM before)
        SELECT cell_tower_id, delta_minutes, signal_drop FROM gaps
        WHERE delta_minutes < :minutes AND signal_drop > :drop
        ORDER BY signal_drop DESC, cell_tower_id, timestamp, train_id LIMIT 15""", {"minutes": 5.0, "drop": 50.0}),
    "chronic_failure": ("""
        SELECT train_id, count(*) AS row_count, count_if(status = 'CRITICAL') AS critical_count,
               count_if(status = 'CRITICAL') / CAST(count(*) AS DOUBLE) AS critical_percentage
        FROM telemetry GROUP BY train_id HAVING critical_percentage > :min_share
        ORDER BY critical_percentage DESC, train_id LIMIT 15""", {"min_share": 0.1}),
    "speed_signal_contrast": ("""
        SELECT train_id, round(slow, 2) AS signal_low_speed, round(fast, 2) AS signal_high_speed,
               round(fast - slow, 2) AS delta_signal
        FROM (SELECT train_id, avg(signal_strength_dbm) FILTER (WHERE speed_kmh BETWEEN 0 AND :low) AS slow,
                     avg(signal_strength_dbm) FILTER (WHERE speed_kmh > :high) AS fast
              FROM telemetry GROUP BY train_id)
        WHERE slow IS NOT NULL AND fast IS NOT NULL
        ORDER BY delta_signal DESC, train_id LIMIT 15""", {"low": 100.0, "high": 200.0}),
    "consumption_baseline": ("""
        WITH moving AS (
          SELECT train_id, sum(power_consumption_kw) AS p, count(power_consumption_kw) AS np, sum(speed_kmh) AS s, count(*) AS ns
          FROM telemetry WHERE speed_kmh > :min_speed GROUP BY train_id),
        gap AS (
          SELECT train_id, try_divide(p, np) AS mean,
                 try_divide(try_divide(p, np), s / ns)
                 - (SELECT try_divide(try_divide(sum(p), sum(np)), sum(s) / sum(ns)) FROM moving) AS d FROM moving)
        SELECT train_id, {delta_from_baseline}, CASE WHEN d <= 0 THEN 'Efficient' ELSE 'Inefficient' END AS efficiency_status
        FROM gap ORDER BY mean DESC NULLS LAST, train_id LIMIT 15""", {"min_speed": 0.0, "digits": None}),
    "network_reliability": (f"""
        SELECT lpad(CAST(hour AS STRING), 2, '0') AS hour, bad_signal_percentage FROM (
          SELECT hour(timestamp) AS hour, round(avg(CAST(CAST({_WEAK} AS INT) AS DOUBLE)), 4) AS bad_signal_percentage
          FROM telemetry GROUP BY hour(timestamp))
        ORDER BY bad_signal_percentage DESC, hour""", {"signal": -100.0}),
}
# Values that a caller may round: the expression behind each {name} above.
_VALUES = {
    "avg_speed_kmh": "avg(speed_kmh)", "avg_signal_str": "avg(signal_strength_dbm)", "power_sum": "sum(power_consumption_kw)",
    "speed_sum": "sum(speed_kmh)", "delta_from_baseline": "d",
}


def run_named(spark: SparkSession, name: str, table: DataFrame, **params) -> DataFrame:
    """Run the named report over ``table`` (registered as the view ``telemetry``)."""
    text, defaults = SQL_REPORTS[name]
    unknown = set(params) - set(defaults)
    if unknown:
        raise ValueError(f"{name} has no parameter {', '.join(sorted(unknown))}")
    args = {**defaults, **params}
    digits = args.pop("digits", None)
    # round() takes a constant number of digits, so this one is written into the text, as an integer
    shown = {k: f"{v} AS {k}" if digits is None else f"round({v}, {int(digits)}) AS {k}" for k, v in _VALUES.items()}
    table.createOrReplaceTempView("telemetry")
    return spark.sql(text.format(**shown), args=args)
