"""Toy-row tests for the semantic traps and threshold boundaries."""


from fleetscope.plans import reports as R
from fleetscope.functions.expr import clip, speed_band
from fleetscope.operators.lag import previous_row
from toy import frame, row


def test_speed_band_edges_and_null(spark):
    speeds = [0.0, 50.0, 50.01, 100.0, 200.0, 200.01, 250.0, 300.0, None]
    df = spark.createDataFrame([(s,) for s in speeds], "speed_kmh double")
    out = df.select("speed_kmh", speed_band().alias("sql"), speed_band(null_to_last=False).alias("bin")).collect()
    got = {r.speed_kmh: (r.sql, r.bin) for r in out}
    assert got[50.0] == ("01: 0-50", "01: 0-50")          # upper-inclusive
    assert got[50.01][0] == "02: 50-100"
    assert got[200.01][0] == "05: 200-250"
    assert got[300.0][0] == "06: 250-300"
    assert got[None] == ("06: 250-300", None)              # SQL ELSE vs interval binning


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (999.0,), (-5.0,), (60.0,)], "t double")
    vals = [r[0] for r in df.select(clip("t", 0.0, 120.0)).collect()]
    assert vals == [None, 120.0, 0.0, 60.0]


def test_temp_jump_threshold_strict_vs_inclusive(spark):
    rows = [row(minutes=0, temp=40.0), row(minutes=1, temp=70.0),    # exactly 30
            row(minutes=2, temp=None), row(minutes=3, temp=10.0),     # NULL breaks the pair on both sides
            row(minutes=4, temp=40.01)]                               # 30.01
    t = frame(spark, rows)
    strict = R.temp_jumps(t).collect()
    incl = R.temp_jumps(t, mode=R.RAW).collect()
    assert [round(r.delta_temp, 2) for r in strict] == [30.01]
    assert sorted(round(r.delta_temp, 2) for r in incl) == [30.0, 30.01]
    assert strict[0].delta_timestamp == 60.0


def test_signal_drop_rounded_minutes(spark):
    # gaps of 4:29 (rounds to 4), 4:30 (rounds to 5 -> out), 5:00 (out); drops of 60
    rows = [row(train="A", minutes=0, signal=-40.0), row(train="B", minutes=4 + 29 / 60, signal=-100.0),
            row(train="A", minutes=20, signal=-40.0), row(train="B", minutes=24.5, signal=-100.0),
            row(train="A", minutes=40, signal=-40.0), row(train="B", minutes=45, signal=-100.0)]
    t = frame(spark, rows)
    canon = R.signal_drops(t).collect()
    unrounded = R.signal_drops(t, mode=R.RAW).collect()
    assert [r.delta_minutes for r in canon] == [4.0]
    assert sorted(round(r.delta_minutes, 3) for r in unrounded) == [4.483, 4.5]


def test_blackout_boundary_and_share(spark):
    rows = [row(signal=-100.0), row(signal=-100.01, minutes=1), row(network="OFFLINE", minutes=2),
            row(minutes=3)]
    out = R.segment_blackout(frame(spark, rows)).collect()
    assert out[0].blackout_ratio == 0.5


def test_chronic_share_strictly_above(spark):
    rows = [row(train="A", minutes=i, status="CRITICAL" if i == 0 else "OK") for i in range(10)]
    rows += [row(train="B", minutes=i, status="CRITICAL" if i < 2 else "OK") for i in range(10)]
    out = R.chronic_failure(frame(spark, rows)).collect()
    assert [(r.train_id, r.critical_count, r.row_count) for r in out] == [("B", 2, 10)]


def test_all_null_power_group_and_zero_speed_sum(spark):
    rows = [row(train="A", power=None, speed=20.0), row(train="A", power=None, speed=30.0, minutes=1),
            row(train="B", power=100.0, speed=20.0)]
    out = {r.train_id: r for r in R.power_speed_ratio(frame(spark, rows)).collect()}
    assert out["A"].power_sum is None and out["A"].ratio is None
    assert out["B"].ratio == 5.0


def test_baseline_null_label(spark):
    rows = [row(train="A", power=None, speed=20.0), row(train="B", power=100.0, speed=20.0)]
    canon = {r.train_id: r.efficiency_status for r in R.consumption_baseline(frame(spark, rows)).collect()}
    raw = {r.train_id: r.efficiency_status for r in R.consumption_baseline(frame(spark, rows), mode=R.RAW).collect()}
    assert canon["A"] == "Inefficient" and raw["A"] == "Efficient"


def test_speed_band_spine_has_all_bands(spark):
    rows = [row(speed=10.0), row(speed=None, minutes=1)]
    out = R.signal_by_speed_band(frame(spark, rows), mode=R.RAW).collect()
    assert len(out) == 6 and sum(r.avg_signal_str is not None for r in out) == 1
    canon = R.signal_by_speed_band(frame(spark, rows)).collect()
    assert sorted(r.speed_ranges for r in canon) == ["01: 0-50", "06: 250-300"]


def test_contrast_round_first_vs_after(spark):
    rows = [row(speed=50.0, signal=-60.004), row(speed=250.0, signal=-80.006, minutes=1)]
    c = R.speed_signal_contrast(frame(spark, rows)).collect()[0]
    v = R.speed_signal_contrast(frame(spark, rows), mode=R.RAW).collect()[0]
    assert c.delta_signal == -20.0 and round(v.delta_signal, 6) == -20.01


def test_previous_row_is_previous_row_not_previous_non_null(spark):
    rows = [row(minutes=0, temp=10.0), row(minutes=1, temp=None), row(minutes=2, temp=50.0)]
    out = previous_row(frame(spark, rows), "train_id", ["timestamp"], ["temp_celsius"]).orderBy("timestamp").collect()
    assert [r.previous_temp_celsius for r in out] == [None, 10.0, None]


def test_multi_level_lag_equals_plain_lag(spark):
    # readings spread over several days, several per minute, NULL values, an empty day in between
    rows = [row(train=f"T{k}", minutes=m / 4, temp=None if m % 11 == 0 else float(m % 97), tower=f"W{m % 3}")
            for k in range(3) for m in range(0, 5 * 1440 * 4, 331) if not (2880 * 4 <= m < 4320 * 4)]
    t = frame(spark, rows)
    for key, order in [("train_id", ["timestamp"]), ("cell_tower_id", ["timestamp", "train_id"])]:
        plain = previous_row(t, key, order, ["temp_celsius", "timestamp"], buckets=())
        for buckets in [("day",), ("minute", "day"), ("minute", "hour", "day")]:
            multi = previous_row(t, key, order, ["temp_celsius", "timestamp"], buckets=buckets)
            assert plain.exceptAll(multi).count() == 0 and multi.exceptAll(plain).count() == 0, buckets


def test_temp_jump_year_difference_variant(spark):
    from datetime import datetime
    from toy import T0
    rows = [row(minutes=0, temp=10.0), row(minutes=1, temp=50.0)]
    ny = [("TRN-2", datetime(2024, 12, 31, 23, 59), 10.0), ("TRN-2", datetime(2025, 1, 1, 0, 1), 60.0)]
    t = frame(spark, rows).unionByName(
        spark.createDataFrame([(a, b, c) for a, b, c in ny], "train_id string, timestamp timestamp_ntz, temp_celsius double"),
        allowMissingColumns=True)
    got = {r.train_id: r.delta_timestamp for r in R.temp_jumps(t, timestamp_delta="years").collect()}
    assert got == {"TRN-1": 0.0, "TRN-2": 1.0}
    secs = {r.train_id: r.delta_timestamp for r in R.temp_jumps(t).collect()}
    assert secs == {"TRN-1": 60.0, "TRN-2": 120.0}
    assert T0.year == 2024


def test_multi_level_lag_null_key_is_a_group(spark):
    rows = [row(train=None, minutes=m, temp=float(m)) for m in (0, 1, 1500, 3000)]
    rows += [row(train="A", minutes=m, temp=float(-m)) for m in (0, 2000)]
    from pyspark.sql import types as T
    from fleetscope.schema import TELEMETRY
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in TELEMETRY.fields])
    t = spark.createDataFrame(rows, schema)
    plain = previous_row(t, "train_id", ["timestamp"], ["temp_celsius"], buckets=())
    multi = previous_row(t, "train_id", ["timestamp"], ["temp_celsius"], buckets=("minute", "day"))
    key = lambda r: (str(r.train_id), r.timestamp)
    assert sorted(plain.collect(), key=key) == sorted(multi.collect(), key=key)
