"""Registered report queries (R1-R11 canonical, V1-V11 dataframe variants, G1-G2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetscope.plans import reports as R
from fleetscope.plans.catalog import register
from fleetscope.plans.oracle import band_sql
from fleetscope.plans.sql_reports import run_named
from fleetscope.schema import SPEED_LABELS
from fleetscope.sources.fixture import raw_telemetry, train_telemetry

# The oracle statements reach each result by another way than the Spark plans: FILTER clauses, QUALIFY, list functions and
# window averages in place of conditional sums, nested lags and joins of aggregates.
WEAK = "(coalesce(signal_strength_dbm < -100, false) OR coalesce(network_type = 'OFFLINE', false))"
HH = "strftime(timestamp, '%H')"
HI = "CAST(hour(timestamp) AS INT)"


def _share(cond: str) -> str:
    return f"CAST(count(*) FILTER ({cond}) AS DOUBLE) / count(*)"


def _first(rows: str, order: str, k: int) -> str:
    return f"{rows} QUALIFY row_number() OVER (ORDER BY {order}) <= {k}"


def _r01(table, hour):
    return f"SELECT {hour} AS hour, round(avg(speed_kmh), 6) AS avg_speed_kmh FROM {table} GROUP BY ALL"


def _r02(table):
    per = f"SELECT train_id, count(*) FILTER (status = 'CRITICAL') AS critical_count FROM {table} GROUP BY ALL HAVING critical_count > 0"
    return _first(f"SELECT * FROM ({per})", "critical_count DESC, train_id", 10)


def _r04(table, op):
    # each train's readings as one ordered list; a reading is compared with the list entry before it
    lists = f"""SELECT train_id, list(struct_pack(t := timestamp, c := temp_celsius) ORDER BY timestamp, temp_celsius) AS r
FROM {table} GROUP BY train_id"""
    steps = f"""SELECT train_id, r[i].t AS seen, abs(epoch(r[i].t) - epoch(r[i - 1].t)) AS delta_timestamp,
  abs(r[i].c - r[i - 1].c) AS delta_temp FROM ({lists}), unnest(range(2, len(r) + 1)) AS u(i)"""
    kept = f"SELECT * FROM ({steps}) WHERE delta_temp {op} 30"
    return f"SELECT train_id, delta_timestamp, delta_temp FROM ({_first(kept, 'delta_temp DESC, train_id, seen', 30)})"


def _r05(table, rnd):
    return f"SELECT line_segment, {rnd}({_share(WEAK)}, 4) AS blackout_ratio FROM {table} GROUP BY ALL"


def _r06(table, rnd):
    per = f"""SELECT train_id, sum(power_consumption_kw) AS p, sum(speed_kmh) AS s
FROM {table} WHERE speed_kmh > 10 GROUP BY ALL"""
    rows = f"SELECT train_id, round(p, 6) AS power_sum, round(s, 6) AS speed_sum, {rnd}(p / s, 2) AS ratio FROM ({per})"
    return _first(rows, "ratio DESC NULLS LAST, train_id", 15)


def _r07(table, minutes):
    # the reading before at the tower: the last one of a running list of two
    steps = f"""SELECT cell_tower_id, timestamp, train_id, signal_strength_dbm,
  list(struct_pack(t := timestamp, s := signal_strength_dbm)) OVER (PARTITION BY cell_tower_id
    ORDER BY timestamp, train_id, signal_strength_dbm ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS b FROM {table}"""
    near = f"""SELECT cell_tower_id, timestamp, train_id, {minutes} AS delta_minutes,
  abs(b[1].s - signal_strength_dbm) AS signal_drop FROM ({steps})"""
    kept = f"SELECT * FROM ({near}) WHERE signal_drop > 50 AND delta_minutes < 5"
    rows = _first(kept, "signal_drop DESC, cell_tower_id, timestamp, train_id", 15)
    return f"SELECT cell_tower_id, delta_minutes, signal_drop FROM ({rows})"


def _r08(table):
    rows = f"""SELECT train_id, count(*) AS row_count, count(*) FILTER (status = 'CRITICAL') AS critical_count,
  {_share("status = 'CRITICAL'")} AS critical_percentage FROM {table} GROUP BY ALL HAVING critical_percentage > 0.1"""
    return _first(f"SELECT * FROM ({rows})", "critical_percentage DESC, train_id", 15)


def _r09(table, low, high, delta):
    # one aggregate split by a band; a train without readings in a band has no mean there
    per = f"""SELECT train_id, avg(signal_strength_dbm) FILTER (speed_kmh BETWEEN 0 AND 100) AS l,
  avg(signal_strength_dbm) FILTER (speed_kmh > 200) AS h FROM {table} GROUP BY ALL"""
    rows = f"""SELECT train_id, {low} AS signal_low_speed, {high} AS signal_high_speed, {delta} AS delta_signal
FROM ({per}) WHERE l + h IS NOT NULL"""
    return _first(rows, "delta_signal DESC, train_id", 15)


R09 = ("round(l, 2)", "round(h, 2)", "round(h - l, 2)")


def _r10(table, status):
    # fleet means as window averages over all moving rows, then one row per train
    rows = f"""SELECT train_id, avg(power_consumption_kw) OVER per AS p, avg(speed_kmh) OVER per AS s,
  avg(power_consumption_kw) OVER () / avg(speed_kmh) OVER () AS fleet
FROM {table} WHERE speed_kmh > 0 WINDOW per AS (PARTITION BY train_id)"""
    trains = f"SELECT DISTINCT ON (train_id) train_id, p, p / s - fleet AS d FROM ({rows})"
    best = _first(f"SELECT * FROM ({trains})", "p DESC NULLS LAST, train_id", 15)
    return f"SELECT train_id, round(d, 6) AS delta_from_baseline, {status} AS efficiency_status FROM ({best})"


def _r11(table, hour, rnd):
    return f"""SELECT {hour} AS hour, {rnd}({_share(WEAK)}, 4) AS bad_signal_percentage
FROM {table} GROUP BY ALL ORDER BY bad_signal_percentage DESC, hour"""


# --- canonical reports over the de-duplicated table -------------------------


@register("r01_hourly_speed", _r01("train_telemetry", HH))
def r01(spark, d):
    return R.hourly_speed(train_telemetry(spark, d), digits=6)


@register("r02_top_critical", _r02("train_telemetry"))
def r02(spark, d):
    return R.top_critical(train_telemetry(spark, d))


@register("r03_signal_by_speed_band", f"""SELECT {band_sql('speed_kmh')} AS speed_ranges,
  round(avg(signal_strength_dbm), 6) AS avg_signal_str FROM train_telemetry GROUP BY ALL""")
def r03(spark, d):
    return R.signal_by_speed_band(train_telemetry(spark, d), digits=6)


@register("r04_temp_jumps", _r04("train_telemetry", ">"))
def r04(spark, d):
    return R.temp_jumps(train_telemetry(spark, d))


@register("r05_segment_blackout", _r05("train_telemetry", "round"))
def r05(spark, d):
    return R.segment_blackout(train_telemetry(spark, d))


@register("r06_power_speed_ratio", _r06("train_telemetry", "round"))
def r06(spark, d):
    return R.power_speed_ratio(train_telemetry(spark, d), sum_digits=6)


@register("r07_signal_drops",
          _r07("train_telemetry", "round((epoch(timestamp) - epoch(b[1].t)) / 60e0, 0)"))
def r07(spark, d):
    return R.signal_drops(train_telemetry(spark, d))


@register("r08_chronic_failure", _r08("train_telemetry"))
def r08(spark, d):
    return R.chronic_failure(train_telemetry(spark, d))


@register("r09_speed_signal_contrast", _r09("train_telemetry", *R09))
def r09(spark, d):
    return R.speed_signal_contrast(train_telemetry(spark, d))


@register("r10_consumption_baseline",
          _r10("train_telemetry", "if(d <= 0, 'Efficient', 'Inefficient')"))
def r10(spark, d):
    return R.consumption_baseline(train_telemetry(spark, d), digits=6)


@register("r11_network_reliability", _r11("train_telemetry", HH, "round"))
def r11(spark, d):
    return R.network_reliability(train_telemetry(spark, d))


# --- dataframe-semantics variants over the raw table -------------------------

@register("v01_hourly_speed_raw", _r01("raw_telemetry", HI))
def v01(spark, d):
    return R.hourly_speed(raw_telemetry(spark, d), digits=6, mode=R.RAW)


@register("v02_top_critical_raw", _r02("raw_telemetry"))
def v02(spark, d):
    return R.top_critical(raw_telemetry(spark, d), mode=R.RAW)


@register("v03_speed_band_spine", f"""SELECT label AS speed_ranges,
  round(avg(signal_strength_dbm) FILTER (speed_kmh IS NOT NULL AND {band_sql('speed_kmh')} = label), 6) AS avg_signal_str
FROM raw_telemetry, (SELECT unnest({SPEED_LABELS!r}) AS label) GROUP BY ALL""")
def v03(spark, d):
    return R.signal_by_speed_band(raw_telemetry(spark, d), digits=6, mode=R.RAW)


@register("v04_temp_jumps_inclusive", _r04("raw_telemetry", ">="))
def v04(spark, d):
    return R.temp_jumps(raw_telemetry(spark, d), mode=R.RAW)


@register("v05_segment_blackout_raw", _r05("raw_telemetry", "round_even"))
def v05(spark, d):
    return R.segment_blackout(raw_telemetry(spark, d), mode=R.RAW)


@register("v06_power_speed_raw", _r06("raw_telemetry", "round_even"))
def v06(spark, d):
    return R.power_speed_ratio(raw_telemetry(spark, d), sum_digits=6, mode=R.RAW)


@register("v07_signal_drops_unrounded",
          _r07("raw_telemetry", "(epoch(timestamp) - epoch(b[1].t)) / 60e0"))
def v07(spark, d):
    return R.signal_drops(raw_telemetry(spark, d), mode=R.RAW)


@register("v08_chronic_raw", _r08("raw_telemetry"))
def v08(spark, d):
    return R.chronic_failure(raw_telemetry(spark, d), mode=R.RAW)


@register("v09_contrast_round_first",
          _r09("raw_telemetry", "round_even(l, 2)", "round_even(h, 2)", "round_even(h, 2) - round_even(l, 2)"))
def v09(spark, d):
    return R.speed_signal_contrast(raw_telemetry(spark, d), mode=R.RAW)


@register("v10_baseline_null_efficient",
          _r10("raw_telemetry", "if(d > 0, 'Inefficient', 'Efficient')"))
def v10(spark, d):
    return R.consumption_baseline(raw_telemetry(spark, d), digits=6, mode=R.RAW)


@register("v11_network_reliability_raw", _r11("raw_telemetry", HI, "round_even"))
def v11(spark, d):
    return R.network_reliability(raw_telemetry(spark, d), mode=R.RAW)


# --- chart input frames ------------------------------------------------------

@register("g01_blackout_sorted", _r05("train_telemetry", "round") + " ORDER BY blackout_ratio DESC, line_segment")
def g01(spark, d):
    return R.segment_blackout(train_telemetry(spark, d)).orderBy(F.desc("blackout_ratio"), "line_segment")


@register("g02_efficiency_sorted", f"SELECT * FROM ({_r06('train_telemetry', 'round')}) ORDER BY ratio DESC NULLS LAST, train_id")
def g02(spark, d):
    return R.power_speed_ratio(train_telemetry(spark, d), sum_digits=6).orderBy(F.desc_nulls_last("ratio"), "train_id")


# --- the SQL path (I15) ---------------------------------------------------------


def _named(key, report, sql, **params):
    @register(key, sql)
    def run(spark, d):
        return run_named(spark, report, train_telemetry(spark, d), **params)


_named("i15_sql_named_report", "chronic_failure", _r08("train_telemetry"))
_named("i15_hourly_speed", "hourly_speed", _r01("train_telemetry", HH), digits=6)
_named("i15_top_critical", "top_critical", _r02("train_telemetry"))
_named("i15_signal_by_speed_band", "signal_by_speed_band", f"""SELECT {band_sql('speed_kmh')} AS speed_ranges,
  round(avg(signal_strength_dbm), 6) AS avg_signal_str FROM train_telemetry GROUP BY ALL""", digits=6)
_named("i15_temp_jumps", "temp_jumps", _r04("train_telemetry", ">"))
_named("i15_segment_blackout", "segment_blackout", _r05("train_telemetry", "round"))
_named("i15_power_speed_ratio", "power_speed_ratio", _r06("train_telemetry", "round"), digits=6)
_named("i15_signal_drops", "signal_drops", _r07("train_telemetry", "round((epoch(timestamp) - epoch(b[1].t)) / 60e0, 0)"))
_named("i15_speed_signal_contrast", "speed_signal_contrast", _r09("train_telemetry", *R09))
_named("i15_consumption_baseline", "consumption_baseline",
       _r10("train_telemetry", "if(d <= 0, 'Efficient', 'Inefficient')"), digits=6)
_named("i15_network_reliability", "network_reliability", _r11("train_telemetry", HH, "round"))
