"""Command-line entry points (one Spark job each).

  python -m fleetscope load    SOURCE TABLE [--format parquet|csv] [--newest STEM] [--ids] [--range COLUMN LOW HIGH]
  python -m fleetscope reports TABLE OUT_DIR [--mode canonical|raw] [--limit SECONDS] [--where TEXT] [--param NAME VALUE]
  python -m fleetscope mart    SOURCE OUT --scratch DIR [--newest STEM] [--partition-by-date]

``load`` appends new (train_id, timestamp) keys of SOURCE to the day-partitioned
Parquet TABLE (idempotent) and prints what it read and rejected, with ``--ids`` it
numbers the rows over all loads; ``reports`` runs the eleven
reports over TABLE, or over its rows for which the condition TEXT with the
named values (numbers, else text) is true, interrupts those that take longer
than the limit, and writes one CSV per non-empty report plus a manifest;
``mart`` builds the BI mart from raw telemetry and writes it clustered by
(DateKey, train_id, TimeKey).  With ``--newest`` SOURCE is a folder and its
newest snapshot STEM*.parquet, else STEM*.csv, is read.  ``mart`` keeps the
unique rows in a new folder under DIR while it runs and removes it.
The master and resources come from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import functions as F

from fleetscope.session import get_session
from fleetscope.sources import files as IO


def _value(text: str) -> int | float | str:
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="fleetscope")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("load")
    a.add_argument("source")
    a.add_argument("table")
    a.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    a.add_argument("--newest", metavar="STEM")
    a.add_argument("--ids", action="store_true")
    a.add_argument("--range", nargs=3, action="append", default=[], metavar=("COLUMN", "LOW", "HIGH"))
    r = sub.add_parser("reports")
    r.add_argument("table")
    r.add_argument("out_dir")
    r.add_argument("--mode", default="canonical", choices=["canonical", "raw"])
    r.add_argument("--limit", type=float, metavar="SECONDS")
    r.add_argument("--where", metavar="TEXT")
    r.add_argument("--param", nargs=2, action="append", default=[], metavar=("NAME", "VALUE"))
    m = sub.add_parser("mart")
    m.add_argument("source")
    m.add_argument("out")
    m.add_argument("--scratch", required=True)
    m.add_argument("--newest", metavar="STEM")
    m.add_argument("--partition-by-date", action="store_true")
    args = ap.parse_args(argv)

    # the reports share the cores evenly, each in its own pool
    spark = get_session(extra={"spark.scheduler.mode": "FAIR"} if args.cmd == "reports" else None)
    source, fmt = getattr(args, "source", None), getattr(args, "format", "parquet")
    if getattr(args, "newest", None):
        found = [(p, f) for f in ("parquet", "csv") if (p := IO.newest_path(spark, source, args.newest, f".{f}"))]
        if not found:
            raise FileNotFoundError(f"no {args.newest}*.parquet or {args.newest}*.csv in {source}")
        source, fmt = found[0]
    if args.cmd == "load":
        from fleetscope.sources.ingest import load_files
        ranges = {c: (float(lo), float(hi)) for c, lo, hi in args.range}
        print(load_files(spark, source, args.table, fmt=fmt, ranges=ranges, id_name="id" if args.ids else None))
    elif args.cmd == "reports":
        from fleetscope.operators.where import where
        from fleetscope.plans.manifest import run_reports
        from fleetscope.sources.files import write_csv
        table = spark.read.parquet(args.table)
        if args.where:
            table = where(table, args.where, **{k: _value(v) for k, v in args.param})
        manifest = run_reports(spark, table, args.out_dir, mode=args.mode, limit_s=args.limit)
        write_csv(manifest.coalesce(1), f"{args.out_dir.rstrip('/')}/_manifest")
    elif args.cmd == "mart":
        from fleetscope.plans import mart as M
        from fleetscope.schema import TELEMETRY
        # the first copy of a key in file arrival order survives the de-duplication
        file = [F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("path")]
        if fmt == "csv":
            place = F.struct(*file, F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
            raw = IO.read_csv(spark, source, TELEMETRY, tag=place.alias("_arrival"))
        else:
            raw = spark.read.parquet(source).withColumn("_arrival", F.struct(*file, F.col("_metadata.row_index").alias("row")))
        kept = f"{args.scratch.rstrip('/')}/mart-{uuid.uuid4().hex}"
        try:
            IO.write_parquet(M.unique_rows(raw, order=["_arrival"]), kept)
            M.write_mart(M.bi_mart(IO.read_parquet(spark, kept)), args.out, args.partition_by_date)
        finally:
            IO.remove_path(spark, kept)


if __name__ == "__main__":
    main()
