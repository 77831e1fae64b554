"""A table laid out for the key: bucketed and sorted files, so that later jobs need no shuffle of it.

Rows of one key are in one bucket file (the hash that Spark's own shuffle uses), sorted by the key and time. A window or an
aggregate on the key, or on the key and more columns, then runs where the files are read, and so does the check of a batch
against the stored keys: only the batch is shuffled. Everything goes through Spark's bucketed tables; the files lie under a path
of the caller's choice.

A key that carries much of the table fills one bucket. ``write_bucketed`` counts the buckets first and refuses such a table; the
day-partitioned layout of ``ingest`` is the one for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetscope.operators.dedup import keep_first
from fleetscope.operators.lag import HOT_ROWS
from fleetscope.schema import COLUMNS, KEYS


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that Spark puts a key into."""
    return F.pmod(F.hash(key), F.lit(buckets))


def largest_bucket(df: DataFrame, key: str, buckets: int) -> tuple[int, int]:
    """Rows of the fullest bucket, and all rows."""
    per = df.groupBy(bucket_of(key, buckets).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    most, rows = per.agg(F.max("n"), F.sum("n")).first()
    return most or 0, rows or 0


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = KEYS[0], order: Sequence[str] = KEYS[1:],
                   max_skew: float = 8.0) -> None:
    """Create ``table`` from ``df``: ``buckets`` files under ``path``, each sorted by (key, order).

    A bucket with more than ``HOT_ROWS`` rows and more than ``max_skew`` times the mean is an error.
    """
    most, rows = largest_bucket(df, key, buckets)
    if most > max(HOT_ROWS, max_skew * rows / buckets):
        raise ValueError(f"one of {buckets} buckets would hold {most} of {rows} rows: use the day-partitioned layout")
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *order).option("path", path).format("parquet")
       .mode("error").saveAsTable(table))


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, str]:
    """Number of buckets and the bucket column of ``table``."""
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(said["Num Buckets"]), said["Bucket Columns"].strip("[]").strip("`")


@contextmanager
def _keep_buckets(spark: SparkSession):
    """Joins on more columns than the bucket key leave the bucketed side in place; the session's setting is put back after."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def new_rows(batch: DataFrame, table: str, keys: Sequence[str] = KEYS, order: Sequence[str | Column] = ("event_id",),
             columns: Sequence[str] = COLUMNS) -> DataFrame:
    """The first row of every key of ``batch`` that ``table`` does not have, NULL keys left out."""
    spark = batch.sparkSession
    stored = spark.table(table).select(*keys, F.lit(True).alias("_stored"))
    # The batch is dealt out as the table is, once: its first rows are found there, and the check finds both sides in place.
    dealt = batch.repartition(*bucket_spec(spark, table))
    # merge: the bucketed side is read file by file and not held whole
    return (keep_first(dealt, list(keys), list(order)).select(*columns)
            .join(stored.hint("merge"), list(keys), "left").filter(F.col("_stored").isNull()).select(*columns))


def insert_bucketed(batch: DataFrame, table: str, keys: Sequence[str] = KEYS, order: Sequence[str | Column] = ("event_id",),
                    columns: Sequence[str] = COLUMNS) -> int:
    """Insert-or-ignore into a bucketed table; the rows inserted.

    The new rows go to one more file of every bucket that gets any. Running a batch again inserts nothing.
    """
    spark, seen = batch.sparkSession, Observation()
    with _keep_buckets(spark):
        new = new_rows(batch, table, keys, order, columns).observe(seen, F.count(F.lit(1)).alias("n"))
        new.select(*spark.table(table).columns).write.insertInto(table)
    return seen.get["n"]
