"""Registered source/sink, ingest, window, join and scalar-expression queries
(I*, W*, J1, P*, A*)."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from fleetscope.functions.expr import blackout, flag, speed_band
from fleetscope.operators.aggregate import top_k, value_counts
from fleetscope.operators.cleanse import drop_null_rows, range_reject_flag
from fleetscope.operators.dedup import keep_first
from fleetscope.operators.lag import previous_row
from fleetscope.operators.where import where
from fleetscope.plans import mart as M
from fleetscope.plans.catalog import register
from fleetscope.plans.manifest import run_reports
from fleetscope.plans.oracle import band_sql
from fleetscope.schema import COLUMNS, TELEMETRY, TEMP_MAX, TEMP_MIN
from fleetscope.sources import files as IO
from fleetscope.sources import ingest as ING
from fleetscope.sources import layout as LAY
from fleetscope.sources.fixture import RAW_EXTRA, raw_telemetry, train_telemetry

COLS = ", ".join(COLUMNS)
FIRST_LOAD_END = "2024-01-16 00:00:00"  # the first load holds the readings before this instant

# --- sources and sinks --------------------------------------------------------


@register("i01_scan_parquet", "SELECT event_id, ts, user_id, event_type, value FROM events WHERE value > 100")
def i01(spark, d):
    # column subset -> ReadSchema; comparison -> PushedFilters (row-group skipping)
    return IO.read_parquet(spark, f"{d}/events.parquet", ["event_id", "ts", "user_id", "event_type", "value"]) \
             .filter(F.col("value") > 100)


@register("i03_csv_roundtrip", f"SELECT {COLS} FROM train_telemetry")
def i03(spark, d):
    path = IO.scratch_path(spark, "csv")
    IO.write_csv(train_telemetry(spark, d).select(*COLUMNS), path)
    return IO.read_csv(spark, path, TELEMETRY)


@register("i03_csv_raw_order", f"SELECT {COLS} FROM train_telemetry")
def i03_raw(spark, d):
    """A raw CSV: other column order, and columns that the table lacks; read by its header."""
    path = IO.scratch_path(spark, "csv-raw")
    raw = train_telemetry(spark, d).select(*reversed(COLUMNS)).withColumns(
        {"speed_modifier": F.lit(1.0), "hour_noise": F.lit(1.0), "signal_malus": F.lit(0.0)})
    IO.write_csv(raw, path)
    return IO.read_csv(spark, path, TELEMETRY)


@register("i04_report_read_back", """SELECT line_segment, n, CAST(0 AS BIGINT) AS empty_read, CAST(0 AS BIGINT) AS missing_read
FROM (SELECT line_segment, count(*) AS n FROM train_telemetry GROUP BY ALL)""")
def i04(spark, d):
    """A report written and read back; an empty one and a missing one read as absent."""
    path = IO.scratch_path(spark, "read-back")
    report = train_telemetry(spark, d).groupBy("line_segment").agg(F.count(F.lit(1)).alias("n"))
    IO.write_csv(report, f"{path}/full")
    IO.write_csv(report.limit(0), f"{path}/empty")
    back, empty, missing = (IO.read_report_csv(spark, f"{path}/{x}", report.schema) for x in ("full", "empty", "missing"))
    return back.withColumns({"empty_read": F.lit(int(empty is not None)).cast("bigint"),
                             "missing_read": F.lit(int(missing is not None)).cast("bigint")})


@register("i05_latest_snapshot", f"SELECT {COLS} FROM train_telemetry")
def i05(spark, d):
    """The newest of two snapshots, a folder of several part files beside an older one."""
    folder = IO.scratch_path(spark, "snapshots")
    table = train_telemetry(spark, d).select(*COLUMNS)
    IO.write_parquet(table.filter("status = 'OK'"), f"{folder}/telemetry_1.parquet")
    IO.write_parquet(table.repartition(4), f"{folder}/telemetry_0.parquet")
    return IO.latest_of(spark, folder, "telemetry")


@register("i07_parquet_roundtrip", f"SELECT {COLS} FROM train_telemetry")
def i07(spark, d):
    path = IO.scratch_path(spark, "parquet")
    IO.write_parquet(train_telemetry(spark, d).select(*COLUMNS), path)
    return IO.read_parquet(spark, path)


@register("i08_conform_schema", f"""SELECT {COLS.replace('speed_kmh', 'if(event_id % 9 = 0, NULL, speed_kmh) AS speed_kmh')}
FROM raw_telemetry WHERE event_id % 7 <> 0""")
def i08(spark, d):
    """Rows with a NULL key (every seventh here) are dropped, a value of a wrong type (every ninth) becomes NULL."""
    raw = raw_telemetry(spark, d).withColumns({
        "train_id": F.when(F.col("event_id") % 7 != 0, F.col("train_id")),
        "speed_kmh": F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.col("speed_kmh").cast("string"))})
    return ING.conform_schema(raw)


@register("f11_drop_null_rows", f"SELECT {COLS} FROM raw_telemetry WHERE temp_celsius + speed_kmh IS NOT NULL")
def f11(spark, d):
    return drop_null_rows(raw_telemetry(spark, d), ["temp_celsius", "speed_kmh"]).select(*COLUMNS)


@register("i09_surrogate_id", f"""SELECT row_number() OVER (ORDER BY train_id, timestamp) AS id, {COLS}
FROM train_telemetry""")
def i09(spark, d):
    return ING.surrogate_id(train_telemetry(spark, d).select(*COLUMNS), ["train_id", "timestamp"])


@register("i10_insert_if_absent", f"""SELECT {COLS} FROM tgt
UNION ALL SELECT {COLS} FROM train_telemetry t
WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.train_id = t.train_id AND tgt.timestamp = t.timestamp)""",
          f"tgt AS (SELECT * FROM train_telemetry WHERE timestamp < TIMESTAMP '{FIRST_LOAD_END}')")
def i10(spark, d):
    raw = raw_telemetry(spark, d)
    first = keep_first(raw.filter(F.col("timestamp") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz")),
                       ["train_id", "timestamp"], ["event_id"])
    # second load re-sends everything (overlapping keys must be ignored)
    return ING.insert_if_absent(first, raw)


@register("i10_csv_first_wins", f"SELECT {COLS} FROM train_telemetry ORDER BY ALL")
def i10_csv(spark, d):
    """CSV files loaded twice in which each key comes again later in its file with another payload: the first row of the file stays.

    A key's file is found by its hash, so that the files are written side by side and none grows with the whole input.
    """
    base = IO.scratch_path(spark, "csv-load")
    first = train_telemetry(spark, d).select(*COLUMNS)
    again = first.withColumns({"status": F.lit("AGAIN"), "speed_kmh": F.lit(-1.0)})
    rows = first.withColumn("copy", F.lit(0)).unionByName(again.withColumn("copy", F.lit(1)))
    dealt = rows.repartition("train_id", "timestamp").sortWithinPartitions("copy", "train_id", "timestamp")
    IO.write_csv(dealt.drop("copy"), f"{base}/raw")
    for _ in range(2):
        ING.load_files(spark, f"{base}/raw", f"{base}/table", fmt="csv")
    return IO.read_parquet(spark, f"{base}/table").select(*COLUMNS)


@register("i10_pruned_load", f"""SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS rows,
  bool_or(day IN (SELECT CAST(timestamp AS DATE) FROM later)) AS read_again
FROM (SELECT train_id, timestamp, CAST(timestamp AS DATE) AS day FROM train_telemetry WHERE timestamp < TIMESTAMP '{FIRST_LOAD_END}'
      UNION SELECT train_id, timestamp, CAST(timestamp AS DATE) FROM later) GROUP BY day""",
          """later AS (SELECT train_id, CASE WHEN event_id % 97 = 5 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE timestamp END AS timestamp
  FROM train_telemetry WHERE timestamp >= TIMESTAMP '2024-01-15 00:00:00' AND timestamp < TIMESTAMP '2024-01-17 00:00:00')""")
def i10_pruned(spark, d):
    """A second load of two days, one of them stored already, with stray timestamps of 1970: rows a day, and whether the load reads it."""
    path = IO.scratch_path(spark, "pruned")
    t = train_telemetry(spark, d)
    ING.append_if_absent(t.filter(F.col("timestamp") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz")), path)
    at = F.col("timestamp").cast("string")
    stray = F.when(F.col("event_id") % 97 == 5, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("timestamp"))
    later = t.filter((at >= "2024-01-15") & (at < "2024-01-17")).withColumn("timestamp", stray)
    ING.append_if_absent(later, path)
    days = [r[0] for r in later.select(F.to_date("timestamp")).distinct().collect()]
    table = IO.read_parquet(spark, path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "day=([0-9-]+)", 1).alias("day")
    read = ING.stored_days(spark, path, table.schema, days).select(folder).distinct().withColumn("read_again", F.lit(True))
    per_day = table.groupBy(F.col(ING.DAY).cast("string").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return per_day.join(read, "day", "left").withColumn("read_again", F.coalesce("read_again", F.lit(False)))


@register("i09_ids_on_load", f"""SELECT row_number() OVER (ORDER BY timestamp >= TIMESTAMP '{FIRST_LOAD_END}', train_id, timestamp) AS id, {COLS}
FROM train_telemetry""")
def i09_load(spark, d):
    """Ids that the loader hands out: two loads, the first of which is run again between them and after them."""
    path = IO.scratch_path(spark, "numbered")
    raw = raw_telemetry(spark, d)
    first = F.col("timestamp") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz")
    for batch in (raw.filter(first), raw.filter(first), raw, raw.filter(first)):
        ING.append_if_absent(batch, path, id_name="id")
    return IO.read_parquet(spark, path).select("id", *COLUMNS)


@register("a16_load_counters", f"""SELECT count(*) AS rows, CAST(0 AS BIGINT) AS corrupt, count(*) FILTER (no_key) AS null_keys,
  count(*) FILTER (NOT no_key AND NOT inside) AS out_of_range,
  count(*) FILTER (NOT no_key AND inside) - (SELECT count(*) FROM fresh) AS duplicates,
  (SELECT count(*) FROM fresh WHERE stored) AS known, (SELECT count(*) FROM fresh WHERE NOT stored) AS loaded FROM checked""",
          f"""checked AS (SELECT *, event_id % 41 = 3 AS no_key, coalesce(temp_celsius BETWEEN {TEMP_MIN!r} AND {TEMP_MAX!r}, false) AS inside
  FROM raw_telemetry),
fresh AS (SELECT train_id, timestamp, timestamp < TIMESTAMP '{FIRST_LOAD_END}' AS stored FROM checked WHERE NOT no_key AND inside GROUP BY ALL)""")
def a16_load(spark, d):
    """What the load rejects, counted in its own pass over the source; the first half of the readings is stored before."""
    base = IO.scratch_path(spark, "counted")
    raw = raw_telemetry(spark, d).withColumn("train_id", F.when(F.col("event_id") % 41 != 3, F.col("train_id")))
    IO.write_parquet(raw, f"{base}/all")
    IO.write_parquet(raw.filter(F.col("timestamp") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz")), f"{base}/half")
    ranges = {"temp_celsius": (TEMP_MIN, TEMP_MAX)}
    ING.load_files(spark, f"{base}/half", f"{base}/table", ranges=ranges)
    seen = ING.load_files(spark, f"{base}/all", f"{base}/table", ranges=ranges)
    return spark.createDataFrame([tuple(seen.values())], ", ".join(f"{k} long" for k in seen))


@register("i12_nan_to_null", """SELECT train_id, timestamp,
  CASE WHEN temp_celsius = 999e0 THEN NULL ELSE temp_celsius END AS temp_celsius FROM raw_telemetry""")
def i12(spark, d):
    # the sensor's 999.0 error code arrives as NaN from the device; the loader maps NaN to NULL
    raw = raw_telemetry(spark, d).withColumn(
        "temp_celsius", F.when(F.col("temp_celsius") == 999.0, F.lit(float("nan"))).otherwise(F.col("temp_celsius")))
    return ING.normalise_nans(raw).select("train_id", "timestamp", "temp_celsius")


@register("i13_timestamp_text", """SELECT train_id, timestamp,
  strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp_text FROM raw_telemetry""")
def i13(spark, d):
    return raw_telemetry(spark, d).select("train_id", "timestamp",
                                          F.date_format("timestamp", IO.TS_TEXT).alias("timestamp_text"))


@register("i14_row_count", "SELECT count(*) AS row_count FROM train_telemetry")
def i14(spark, d):
    return train_telemetry(spark, d).agg(F.count(F.lit(1)).alias("row_count"))


# How many rows each report has.
_ROWS = {
    "hourly_speed": "SELECT DISTINCT hour(timestamp) FROM train_telemetry",
    "top_critical": "SELECT DISTINCT train_id FROM train_telemetry WHERE status = 'CRITICAL' LIMIT 10",
    "signal_by_speed_band": f"SELECT DISTINCT {band_sql('speed_kmh')} FROM train_telemetry",
    "temp_jumps": """SELECT 1 FROM (SELECT abs(temp_celsius - lag(temp_celsius) OVER (PARTITION BY train_id ORDER BY timestamp)) AS j
      FROM train_telemetry) WHERE j > 30 LIMIT 30""",
    "segment_blackout": "SELECT DISTINCT line_segment FROM train_telemetry",
    "power_speed_ratio": "SELECT DISTINCT train_id FROM train_telemetry WHERE speed_kmh > 10 LIMIT 15",
    "signal_drops": """SELECT 1 FROM (SELECT abs(signal_strength_dbm - lag(signal_strength_dbm) OVER w) AS s,
        round(date_diff('microsecond', lag(timestamp) OVER w, timestamp) / 6e7, 0) AS m
      FROM train_telemetry WINDOW w AS (PARTITION BY cell_tower_id ORDER BY timestamp, train_id)) WHERE s > 50 AND m < 5 LIMIT 15""",
    "chronic_failure": """SELECT train_id FROM train_telemetry GROUP BY ALL
      HAVING count(*) FILTER (status = 'CRITICAL') > 0.1 * count(*) LIMIT 15""",
    "speed_signal_contrast": """SELECT train_id FROM train_telemetry GROUP BY ALL
      HAVING count(signal_strength_dbm) FILTER (speed_kmh BETWEEN 0 AND 100) > 0
         AND count(signal_strength_dbm) FILTER (speed_kmh > 200) > 0 LIMIT 15""",
    "consumption_baseline": "SELECT DISTINCT train_id FROM train_telemetry WHERE speed_kmh > 0 LIMIT 15",
    "network_reliability": "SELECT DISTINCT hour(timestamp) FROM train_telemetry"}


@register("i16_report_manifest", "SELECT report, n AS rows, if(n = 0, 'empty', 'ok') AS status FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS report, (SELECT count(*) FROM ({sql})) AS n" for name, sql in _ROWS.items()) + ")")
def i16(spark, d):
    return run_reports(spark, train_telemetry(spark, d), IO.scratch_path(spark, "reports")).drop("path")


@register("f13_text_predicate", """SELECT train_id, timestamp, speed_kmh, status, network_type FROM train_telemetry
WHERE speed_kmh BETWEEN 10 AND 120 AND (status = 'CRITICAL' OR network_type IN ('OFFLINE', 'EDGE')) AND timestamp >= TIMESTAMP '2024-01-10 12:00:00'""")
def f13(spark, d):
    """A user's condition as text, its values bound."""
    text = "speed_kmh BETWEEN :low AND :high AND (status = :status OR network_type IN ('OFFLINE', :net)) AND timestamp >= :since"
    found = where(train_telemetry(spark, d), text, low=10, high=120.0, status="CRITICAL", net="EDGE", since=datetime(2024, 1, 10, 12))
    return found.select("train_id", "timestamp", "speed_kmh", "status", "network_type")


@register("i17_bucketed_lag", """SELECT train_id, timestamp, temp_celsius,
  lag(timestamp) OVER w AS previous_timestamp, lag(temp_celsius) OVER w AS previous_temp_celsius
FROM train_telemetry WINDOW w AS (PARTITION BY train_id ORDER BY timestamp)""")
def i17_lag(spark, d):
    """The previous reading off a table bucketed by train: no exchange of the table."""
    name = _bucketed(spark, train_telemetry(spark, d).select(*COLUMNS))
    return previous_row(spark.table(name).select("train_id", "timestamp", "temp_celsius"), "train_id", ["timestamp"], ["timestamp", "temp_celsius"])


@register("i17_bucketed_insert", f"SELECT {COLS} FROM train_telemetry")
def i17_insert(spark, d):
    """Insert-or-ignore into a bucketed table, run twice: only the batch is shuffled."""
    raw = raw_telemetry(spark, d)
    first = keep_first(raw.filter(F.col("timestamp") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz")), ["train_id", "timestamp"], ["event_id"])
    name = _bucketed(spark, first.select(*COLUMNS))
    for _ in range(2):
        LAY.insert_bucketed(raw, name)
    return spark.table(name)


def _bucketed(spark, df) -> str:
    name = f"telemetry_{uuid.uuid4().hex}"
    LAY.write_bucketed(df, name, IO.scratch_path(spark, "bucketed"), buckets=8)
    return name


# --- windows --------------------------------------------------------------------


@register("w01_prev_reading", """SELECT train_id, timestamp, temp_celsius,
  lag(timestamp) OVER w AS previous_timestamp, lag(temp_celsius) OVER w AS previous_temp_celsius
FROM train_telemetry WINDOW w AS (PARTITION BY train_id ORDER BY timestamp)""")
def w01(spark, d):
    t = train_telemetry(spark, d).select("train_id", "timestamp", "temp_celsius")
    return previous_row(t, "train_id", ["timestamp"], ["timestamp", "temp_celsius"])


@register("w03_prev_tower_reading", """SELECT cell_tower_id, timestamp, train_id, signal_strength_dbm,
  lag(timestamp) OVER w AS previous_timestamp, lag(signal_strength_dbm) OVER w AS previous_signal_strength_dbm
FROM train_telemetry WINDOW w AS (PARTITION BY cell_tower_id ORDER BY timestamp, train_id)""")
def w03(spark, d):
    t = train_telemetry(spark, d).select("cell_tower_id", "timestamp", "train_id", "signal_strength_dbm")
    return previous_row(t, "cell_tower_id", ["timestamp", "train_id"], ["timestamp", "signal_strength_dbm"])


@register("w06_keep_first", "SELECT * FROM train_telemetry")
def w06(spark, d):
    return keep_first(raw_telemetry(spark, d), ["train_id", "timestamp"], ["event_id"])


# --- join form of the speed/signal contrast ---------------------------------------


@register("j01_contrast_join", """SELECT train_id, round(l, 2) AS signal_low_speed, round(h, 2) AS signal_high_speed,
  round(h - l, 2) AS delta_signal
FROM (SELECT train_id, avg(signal_strength_dbm) FILTER (speed_kmh BETWEEN 0 AND 100) AS l,
  avg(signal_strength_dbm) FILTER (speed_kmh > 200) AS h FROM train_telemetry GROUP BY ALL)
WHERE l + h IS NOT NULL QUALIFY row_number() OVER (ORDER BY delta_signal DESC, train_id) <= 15""")
def j01(spark, d):
    """The join form: one aggregate per (train, band), whose two bands are then joined."""
    band = F.when(F.col("speed_kmh").between(0, 100), "low").when(F.col("speed_kmh") > 200, "high")
    per = (train_telemetry(spark, d).select("train_id", band.alias("band"), "signal_strength_dbm").filter("band IS NOT NULL")
           .groupBy("train_id", "band").agg(F.avg("signal_strength_dbm").alias("mean")).filter("mean IS NOT NULL"))
    sides = [per.filter(F.col("band") == x).select("train_id", F.col("mean").alias(x)) for x in ("low", "high")]
    both = sides[0].join(sides[1], "train_id").select(
        "train_id", F.round("low", 2).alias("signal_low_speed"), F.round("high", 2).alias("signal_high_speed"),
        F.round(F.col("high") - F.col("low"), 2).alias("delta_signal"))
    return top_k(both, [F.desc("delta_signal"), F.asc("train_id")], 15)


# --- scalar expressions -------------------------------------------------------------


@register("p06_speed_band", f"""SELECT train_id, timestamp, speed_kmh,
  {band_sql('speed_kmh', null_to_last=False)} AS speed_ranges
FROM raw_telemetry""")
def p06(spark, d):
    return raw_telemetry(spark, d).select("train_id", "timestamp", "speed_kmh",
                                          speed_band("speed_kmh", null_to_last=False).alias("speed_ranges"))


@register("p18_casts", """SELECT train_id, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS day, CAST(temp_celsius AS FLOAT) AS temp_f32,
  TRY_CAST(substr(train_id, 5) AS INT) AS train_no, TRY_CAST(status AS INT) AS status_int FROM raw_telemetry""")
def p18(spark, d):
    t = raw_telemetry(spark, d)
    return t.select("train_id", F.col("timestamp").cast("date").cast("string").alias("day"),
                    F.col("temp_celsius").cast("float").alias("temp_f32"),
                    F.substring("train_id", 5, 100).try_cast("int").alias("train_no"),
                    F.col("status").try_cast("int").alias("status_int"))


@register("p26_normalise_id", """SELECT DISTINCT train_id FROM raw_telemetry""")
def p26(spark, d):
    """Ids that arrive in mixed case and with blanks (every other one here) come out as one."""
    odd = F.col("event_id") % 2 == 1
    dirty = F.when(odd, F.concat(F.lit("  "), F.lower("train_id"), F.lit(" "))).otherwise(F.col("train_id"))
    return raw_telemetry(spark, d).select(F.upper(F.trim(dirty)).alias("train_id")).distinct()


# --- aggregates --------------------------------------------------------------------------


@register("a06_flag_rate", """SELECT train_id,
  round(avg(CASE WHEN status = 'CRITICAL' THEN 1e0 ELSE 0e0 END), 6) AS critical_rate FROM raw_telemetry GROUP BY train_id""")
def a06(spark, d):
    t = raw_telemetry(spark, d)
    return t.groupBy("train_id").agg(
        F.round(F.avg(F.coalesce(F.col("status") == "CRITICAL", F.lit(False)).cast("double")), 6).alias("critical_rate"))


@register("a11_value_counts", "SELECT status, count(*) AS count FROM raw_telemetry GROUP BY status ORDER BY count DESC, status")
def a11(spark, d):
    return value_counts(raw_telemetry(spark, d), "status").orderBy(F.desc("count"), "status")


@register("a14_distinct_keys", "SELECT DISTINCT train_id FROM raw_telemetry")
def a14(spark, d):
    return raw_telemetry(spark, d).select("train_id").distinct()


@register("a16_dq_counters", f"""SELECT CAST(sum(n) AS BIGINT) AS rows_in, CAST(sum(bad) AS BIGINT) AS out_of_range,
  CAST(sum(n) - count(*) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n,
  sum(CASE WHEN temp_celsius BETWEEN {TEMP_MIN!r} AND {TEMP_MAX!r} THEN 0 ELSE 1 END) AS bad
  FROM raw_telemetry GROUP BY timestamp, train_id) g""")
def a16(spark, d):
    per_key = raw_telemetry(spark, d).groupBy("timestamp", "train_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(range_reject_flag("temp_celsius", TEMP_MIN, TEMP_MAX)).alias("bad"))
    return per_key.agg(F.sum("n").cast("bigint").alias("rows_in"), F.sum("bad").cast("bigint").alias("out_of_range"),
                       (F.sum("n") - F.count(F.lit(1))).cast("bigint").alias("duplicates"))


@register("a17_dq_flags_by_train", f"""SELECT train_id,
  CAST(sum(CASE WHEN temp_celsius IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_temp,
  CAST(sum(CASE WHEN temp_celsius IS NOT NULL AND temp_celsius > {TEMP_MAX!r} THEN 1 ELSE 0 END) AS BIGINT) AS extreme_temp,
  CAST(sum({'CASE WHEN signal_strength_dbm < -100 OR network_type = ' + "'OFFLINE'" + ' THEN 1 ELSE 0 END'}) AS BIGINT) AS blackouts
FROM train_telemetry GROUP BY train_id""")
def a17(spark, d):
    t = M.add_quality(train_telemetry(spark, d))
    return t.groupBy("train_id").agg(
        F.sum("IsMissingTemp").cast("bigint").alias("missing_temp"),
        F.sum("IsExtremeTemp").cast("bigint").alias("extreme_temp"),
        F.sum(flag(blackout())).cast("bigint").alias("blackouts"))





# --- streaming load -----------------------------------------------------------------------


# --- streaming load -----------------------------------------------------------------------


@register("s01_stream_load", f"SELECT {COLS} FROM train_telemetry")
def s01(spark, d):
    from fleetscope.streaming import load_stream, telemetry_stream
    base = IO.scratch_path(spark, "stream")
    IO.write_parquet(raw_telemetry(spark, d), f"{base}/landing")
    stream = telemetry_stream(spark, f"{base}/landing", extra=RAW_EXTRA)
    load_stream(stream, f"{base}/table", f"{base}/_checkpoint").awaitTermination()
    return IO.read_parquet(spark, f"{base}/table").select(*COLUMNS)
