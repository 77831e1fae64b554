"""The report catalogue: isolation, time limit, job tags and pools (I16)."""

import threading
import time

from pyspark.sql import functions as F

from fleetscope.plans.manifest import run_reports
from tests.toy import frame, row


def good(base, mode):
    return base.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def slow(base, mode):
    """Some minutes of work in one task."""
    return base.sparkSession.range(0, 10 ** 15, 1, 1).agg(F.sum(F.xxhash64("id") % 7).alias("s"))


def broken(base, mode):
    return base.select(F.raise_error(F.lit("no")))


def empty(base, mode):
    return base.filter("false")


def by_name(manifest):
    return {r["report"]: r for r in manifest.collect()}


def test_a_hung_report_ends_as_an_error_and_the_rest_is_ok(spark, tmp_path):
    table = frame(spark, [row("TRN-1"), row("TRN-2", status="CRITICAL")])
    start = time.monotonic()
    got = by_name(run_reports(spark, table, str(tmp_path / "out"), limit_s=6, at_a_time=2,
                              reports={"slow": slow, "good one": good, "broken": broken, "empty": empty, "good two": good}))
    assert time.monotonic() - start < 60
    assert {k: r["status"].split(":")[0] for k, r in got.items()} == {
        "slow": "error", "good one": "ok", "broken": "error", "empty": "empty", "good two": "ok"}
    assert got["slow"]["status"] == "error: timeout" and got["slow"]["path"] is None
    assert spark.read.option("header", True).csv(got["good two"]["path"]).count() == 2
    assert not (tmp_path / "out" / "01_slow").exists()
    # the interrupted job leaves the cluster
    end = time.monotonic() + 20
    while spark.sparkContext.statusTracker().getActiveJobsIds():
        assert time.monotonic() < end
        time.sleep(0.2)


def test_a_report_that_hangs_outside_spark_is_left_behind(spark, monkeypatch):
    monkeypatch.setattr("fleetscope.plans.manifest.GRACE", 0.5)
    free = threading.Event()

    def stuck(base, mode):
        free.wait(60)
        return base

    got = by_name(run_reports(spark, frame(spark, [row()]), None, limit_s=8, reports={"stuck": stuck, "good": good}))
    free.set()
    assert got["stuck"]["status"] == "error: timeout" and got["good"]["status"] == "ok"


def test_reports_inherit_properties_and_have_their_own_tag_and_pool(spark):
    seen = {}

    def look(name):
        def report(base, mode):
            sc = spark.sparkContext
            seen[name] = sc.getLocalProperty("fleet.owner"), sc.getLocalProperty("spark.job.tags"), sc.getLocalProperty("spark.scheduler.pool")
            return base
        return report

    spark.sparkContext.setLocalProperty("fleet.owner", "ops")
    try:
        run_reports(spark, frame(spark, [row()]), None, reports={"Report A": look("a"), "Report B": look("b")}).collect()
    finally:
        spark.sparkContext.setLocalProperty("fleet.owner", None)
    assert seen["a"][0] == seen["b"][0] == "ops"
    assert seen["a"][2] == "report_a" and seen["b"][2] == "report_b"
    assert seen["a"][1].startswith("report-report_a-") and seen["b"][1].startswith("report-report_b-")
    assert not spark.sparkContext.getLocalProperty("spark.job.tags") and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
