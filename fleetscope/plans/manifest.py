"""Run the whole report catalogue over one table (I16).

The input is written once as Parquet into the shared checkpoint folder, so
the eleven reports share one scan and one de-duplication, each report reads
only its own columns of it, and a lost executor recomputes from those files
instead of the whole lineage.  Each report is isolated: it runs under a job
tag and in a scheduler pool of its own, a failure is recorded and the others
still run; one that takes longer than the limit is interrupted by its tag and
recorded as an error; empty results are not written.  Every report is a
distributed job; a few of them run at a time, so that a short one does not
leave the cluster idle.  With ``spark.scheduler.mode=FAIR`` the pools share
the cores evenly; else they change nothing.
"""

from __future__ import annotations

import threading
import time
import uuid

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetscope.plans.reports import CANONICAL, REPORTS
from fleetscope.session import checkpoint_dir
from fleetscope.sources.files import materialize, write_csv

MANIFEST_SCHEMA = T.StructType([
    T.StructField("report", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("path", T.StringType()),
])


def slug(name: str) -> str:
    """File-name-safe lower-case form of a report name."""
    return "".join(ch if ch.isalnum() else "_" for ch in name.lower()).strip("_")


# Reports that run at a time.
AT_A_TIME = 4
# Seconds that an interrupted report has to end before it is left behind, and between two looks.
GRACE, STEP = 10.0, 0.05


class _Late(Exception):
    """The report was interrupted between two of its jobs."""


class _Report:
    """One report on a thread that inherits the caller's local properties, under its own tag."""

    def __init__(self, spark: SparkSession, name: str, fn, base: DataFrame, mode: str, path: str | None):
        self.spark, self.name, self.fn, self.base, self.mode, self.path = spark, name, fn, base, mode, path
        self.tag = f"report-{slug(name)}-{uuid.uuid4().hex}"
        self.late, self.ended, self.started = threading.Event(), threading.Event(), time.monotonic()
        self.row: tuple = (name, None, "error: timeout", None)
        InheritableThread(target=self._run, session=spark, daemon=True).start()

    def _run(self) -> None:
        try:
            sc = self.spark.sparkContext
            sc.addJobTag(self.tag)  # on every job of the thread, a checkpoint's too, not on SQL executions alone
            sc.setLocalProperty("spark.scheduler.pool", slug(self.name))
            row = self._result()
        except Exception as e:  # noqa: BLE001 -- isolate one report's failure
            row = self.name, None, f"error: {type(e).__name__}", None
        if not self.late.is_set():
            self.row = row
        self.ended.set()

    def _result(self) -> tuple:
        res = self.fn(self.base, mode=self.mode)
        self._on_time()
        if self.path:
            res = res.checkpoint(eager=True)  # one computation feeds both the count and the write
        self._on_time()
        n = res.count()
        if n == 0:
            return self.name, 0, "empty", None
        self._on_time()
        if self.path:
            write_csv(res, self.path)
        return self.name, n, "ok", self.path

    def _on_time(self) -> None:
        if self.late.is_set():
            raise _Late

    def over(self, limit_s: float | None) -> bool:
        """Whether the report has ended, or was interrupted and is not waited for any longer."""
        if self.ended.is_set():
            return True
        spent = time.monotonic() - self.started
        if limit_s is None or spent < limit_s:
            return False
        self.late.set()
        self.spark.sparkContext.cancelJobsWithTag(self.tag)  # at every look: a job may have started since the last one
        return spent > limit_s + GRACE


def run_reports(spark: SparkSession, table: DataFrame, out_dir: str | None, mode: str = CANONICAL,
                reports: dict | None = None, limit_s: float | None = None, at_a_time: int = AT_A_TIME) -> DataFrame:
    """Run every report; write non-empty ones as CSV under ``out_dir``; return the manifest.

    A report that has not ended ``limit_s`` seconds after its own start is
    interrupted, gives ``error: timeout`` and writes nothing more.
    """
    checkpoint_dir(spark)
    base = materialize(table, "reports-base")
    waiting = list(enumerate((reports or REPORTS).items(), start=1))[::-1]
    begun: list[_Report] = []
    running: list[_Report] = []
    while waiting or running:
        while waiting and len(running) < at_a_time:
            i, (name, fn) = waiting.pop()
            path = f"{out_dir.rstrip('/')}/{i:02d}_{slug(name)}" if out_dir else None
            begun.append(_Report(spark, name, fn, base, mode, path))
            running.append(begun[-1])
        running = [r for r in running if not r.over(limit_s)]
        if running:
            running[0].ended.wait(STEP)
    return spark.createDataFrame([r.row for r in begun], MANIFEST_SCHEMA)
