"""Sources: newest snapshot by file time (Parquet preferred, CSV fallback), report read-back."""

import os

from pyspark.sql import functions as F

from fleetscope.schema import COLUMNS, TELEMETRY
from fleetscope.sources.files import latest_of, read_report_csv, write_csv
from fleetscope.sources.fixture import train_telemetry

SF = "/root/testdata/sf0.001"


def _single_file(df, folder, name, fmt):
    tmp = os.path.join(folder, f"_{name}")
    w = df.coalesce(1).write.mode("overwrite")
    (w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(tmp)
     if fmt == "csv" else w.parquet(tmp))
    part = [f for f in os.listdir(tmp) if f.startswith("part-")][0]
    dst = os.path.join(folder, f"{name}.{fmt}")
    os.link(os.path.join(tmp, part), dst)
    return dst


def test_latest_snapshot_prefers_newest_parquet(spark, tmp_path):
    t = train_telemetry(spark, SF).select(*COLUMNS)
    old = _single_file(t.filter(F.col("status") == "OK"), str(tmp_path), "telemetry_old", "parquet")
    new = _single_file(t.filter(F.col("status") != "OK"), str(tmp_path), "telemetry_new", "parquet")
    os.utime(old, (1_600_000_000, 1_600_000_000))
    os.utime(new, (1_700_000_000, 1_700_000_000))
    got = latest_of(spark, str(tmp_path), "telemetry")
    assert got.count() == t.filter(F.col("status") != "OK").count()
    assert got.filter(F.col("status") == "OK").count() == 0


def test_latest_snapshot_falls_back_to_csv(spark, tmp_path):
    t = train_telemetry(spark, SF).select(*COLUMNS)
    _single_file(t, str(tmp_path), "telemetry_a", "csv")
    got = latest_of(spark, str(tmp_path), "telemetry", schema=TELEMETRY)
    assert got.count() == t.count()
    assert got.exceptAll(t).count() == 0


def test_report_read_back_skips_missing_and_empty(spark, tmp_path):
    t = train_telemetry(spark, SF).select(*COLUMNS)
    assert read_report_csv(spark, str(tmp_path / "missing"), TELEMETRY) is None
    write_csv(t.limit(0), str(tmp_path / "empty"))
    assert read_report_csv(spark, str(tmp_path / "empty"), TELEMETRY) is None
    write_csv(t, str(tmp_path / "full"))
    back = read_report_csv(spark, str(tmp_path / "full"), TELEMETRY)
    assert back is not None and back.exceptAll(t).count() == 0


def test_mart_write_is_clustered_and_prunable(spark, tmp_path):
    from fleetscope.plans import mart as M
    from fleetscope.sources.fixture import raw_telemetry
    out = str(tmp_path / "mart")
    M.write_mart(M.bi_mart(M.unique_rows(raw_telemetry(spark, SF))), out, partition_by_date=True)
    back = spark.read.parquet(out)
    day = back.select(F.min("DateKey")).first()[0]
    q = back.filter(F.col("DateKey") == day)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DateKey" in plan
    assert q.count() == back.filter(F.col("DateKey") == day).count() > 0
    # inside every written file the rows follow (train_id, TimeKey) within the day
    rows = (back.select("DateKey", "train_id", "TimeKey", F.col("_metadata.file_path").alias("f"))
                .collect())
    by_file = {}
    for r in rows:
        by_file.setdefault(r.f, []).append((r.train_id, r.TimeKey))
    for f, seq in by_file.items():
        assert seq == sorted(seq), f


def test_latest_snapshot_without_rows_is_taken_whole(spark, tmp_path):
    t = train_telemetry(spark, SF).select(*COLUMNS)
    t.write.parquet(str(tmp_path / "telemetry_old.parquet"))
    t.limit(0).write.parquet(str(tmp_path / "telemetry_new.parquet"))
    assert latest_of(spark, str(tmp_path), "telemetry").count() == 0
