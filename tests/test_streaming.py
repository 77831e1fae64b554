"""Streaming load: several micro-batches with overlapping files give the keyed table once."""

import os
import tempfile

from pyspark.sql import functions as F

from fleetscope.operators.dedup import keep_first
from fleetscope.schema import COLUMNS
from fleetscope.sources.fixture import RAW_EXTRA, raw_telemetry
from fleetscope.streaming import load_stream, telemetry_stream

SF = "/root/testdata/sf0.001"


def test_stream_replay_is_idempotent(spark):
    src = tempfile.mkdtemp(prefix="fleetscope-stream-src-")
    out = tempfile.mkdtemp(prefix="fleetscope-stream-out-")
    ev = raw_telemetry(spark, SF)
    # three files: first half, second half, and a replay of everything (overlaps both)
    ev.filter(F.col("timestamp") < "2024-01-15").coalesce(1).write.parquet(os.path.join(src, "a"))
    ev.filter(F.col("timestamp") >= "2024-01-15").coalesce(1).write.parquet(os.path.join(src, "b"))
    ev.coalesce(1).write.parquet(os.path.join(src, "c"))
    folder = os.path.join(src, "all")
    os.makedirs(folder)
    for i, part in enumerate(["a", "b", "c"]):
        f = [x for x in os.listdir(os.path.join(src, part)) if x.endswith(".parquet")][0]
        os.link(os.path.join(src, part, f), os.path.join(folder, f"events-{i}.parquet"))
    q = load_stream(telemetry_stream(spark, folder, "events-*.parquet", 1, RAW_EXTRA),
                    os.path.join(out, "table"), os.path.join(out, "ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(out, "table")).select(*COLUMNS)
    want = keep_first(raw_telemetry(spark, SF), ["train_id", "timestamp"], ["event_id"]).select(*COLUMNS)
    assert got.count() == want.count() == 1000
    assert got.exceptAll(want).count() == 0


def test_stream_starts_on_empty_folder(spark):
    src = tempfile.mkdtemp(prefix="fleetscope-stream-empty-")
    out = tempfile.mkdtemp(prefix="fleetscope-stream-empty-out-")
    q = load_stream(telemetry_stream(spark, src, "events-*.parquet", extra=RAW_EXTRA), os.path.join(out, "table"), os.path.join(out, "ckpt"))
    q.awaitTermination()
    ev = raw_telemetry(spark, SF)
    ev.coalesce(1).write.parquet(os.path.join(src, "_tmp"))
    f = [x for x in os.listdir(os.path.join(src, "_tmp")) if x.endswith(".parquet")][0]
    os.link(os.path.join(src, "_tmp", f), os.path.join(src, "events-late.parquet"))
    q = load_stream(telemetry_stream(spark, src, "events-*.parquet", extra=RAW_EXTRA), os.path.join(out, "table"), os.path.join(out, "ckpt"))
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(out, "table")).count() == 1000
