"""Idempotent load of telemetry batches into the keyed table."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from fleetscope.functions.expr import nan_to_null
from fleetscope.operators.dedup import keep_first
from fleetscope.schema import COLUMNS, DOUBLE_COLUMNS, KEYS, TELEMETRY
from fleetscope.sources.files import CORRUPT, read_csv, remove_path, scratch_path


def conform_schema(df: DataFrame, schema=TELEMETRY, strict: bool = False,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Project to the schema's columns in its order, cast each column, drop NULL keys.

    ``strict=False`` uses ``try_cast`` (a bad value becomes NULL instead of
    failing the job); NOT NULL columns are enforced by filtering.  ``keep``
    names extra columns carried through unchanged (e.g. an arrival order).
    """
    exprs = [F.col(k) for k in keep]
    for f in schema.fields:
        c = F.col(f.name)
        exprs.append((c.cast(f.dataType) if strict else c.try_cast(f.dataType)).alias(f.name))
    out = df.select(*exprs)
    required = [f.name for f in schema.fields if not f.nullable]
    for r in required:
        out = out.filter(F.col(r).isNotNull())
    return out


def normalise_nans(df: DataFrame, cols: Sequence[str] = DOUBLE_COLUMNS) -> DataFrame:
    """NaN -> NULL on the floating columns (NaN would otherwise win max/avg comparisons)."""
    return df.withColumns({c: nan_to_null(c) for c in cols if c in df.columns})


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str] = KEYS,
                     order: Sequence[str | Column] = ("event_id",),
                     columns: Sequence[str] = COLUMNS) -> DataFrame:
    """The table after appending ``batch`` with INSERT-OR-IGNORE semantics.

    Stored rows rank before the batch and the batch is ranked by ``order``;
    the first row of each key is kept.  So a stored key keeps its row, the
    first copy in the batch wins otherwise, and rows with a NULL key are
    skipped.  One shuffle on ``keys`` (with a partial limit before it) and no
    join.  For a large stored table use ``append_if_absent``, which reads only
    the days that the batch touches.
    """
    ranks = [F.col(o) if isinstance(o, str) else o for o in order]
    old = target.select(*columns, F.lit(0).alias("_src"))
    new = batch.select(*columns, F.lit(1).alias("_src"), F.struct(*ranks).alias("_ord"))
    old = old.withColumn("_ord", F.lit(None).cast(new.schema["_ord"].dataType))
    return keep_first(old.unionByName(new), list(keys), ["_src", "_ord"]).select(*columns)


# Bounds of the sampled key ranges in surrogate_id.
KEY_RANGES = 1000


def surrogate_id(df: DataFrame, order: Sequence[str], name: str = "id", start: int = 0) -> DataFrame:
    """Dense ids from ``start`` + 1 in ``order`` = (key, timestamp[, tie-breaks...]), without a global sort.

    ``start`` is the largest id in use, so that ids continue over loads.

    id = start + (rows of smaller keys) + (rows of the same key on earlier days)
       + (rows of that day in earlier minutes) + (position within the minute).
    The three offsets come from count tables (per key / key-day / key-minute,
    each partially aggregated and far smaller than the rows) and are folded
    into one per-(key, minute) offset table; the rows are shuffled once, on
    (key, day, minute), where the position is numbered and the offset joined.
    No range sampling is involved, so the ids are the same on every re-run
    (given a unique ``order``), and no window holds more than one minute of
    one key.  The running total over the distinct keys is split too: sampled
    keys (at most ``KEY_RANGES``) part the key space, totals run inside a
    range, and one window adds up the ranges.
    """
    key, ts, rest = order[0], order[1], list(order[2:])
    # struct key (NULL = NULL inside a struct) and sentinel buckets for NULL timestamps keep
    # NULLs in their own groups while every join stays a plain, co-partitioned equi-join;
    # both sort first, as NULLs do in the ascending order
    first = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    x = df.withColumns({"_k": F.struct(F.col(key)),
                        "_d": F.coalesce(F.date_trunc("day", ts).cast("timestamp_ntz"), first),
                        "_mi": F.coalesce(F.date_trunc("minute", ts).cast("timestamp_ntz"), first)})
    c_min = x.groupBy("_k", "_d", "_mi").agg(F.count(F.lit(1)).alias("_n"))
    c_day = c_min.groupBy("_k", "_d").agg(F.sum("_n").alias("_n"))
    c_key = c_day.groupBy("_k").agg(F.sum("_n").alias("_n"))
    upto = Window.unboundedPreceding
    sample = c_key.orderBy(F.xxhash64("_k"), "_k").limit(KEY_RANGES).select(F.col("_k")[key].alias("k")).collect()
    bounds = sorted(r["k"] for r in sample if r["k"] is not None)
    typ = df.schema[key].dataType
    at = F.size(F.filter(F.array(*[F.lit(x).cast(typ) for x in bounds]), lambda x: x <= F.col("_k")[key])) if bounds else F.lit(0)
    c_key = c_key.withColumn("_g", F.when(F.col("_k")[key].isNull(), F.lit(-1)).otherwise(at))
    ranges = c_key.groupBy("_g").agg(F.sum("_n").alias("_n"))                      # at most KEY_RANGES + 2 rows
    ranges = ranges.select("_g", (F.sum("_n").over(Window.orderBy("_g").rowsBetween(upto, 0)) - F.col("_n")).alias("_og"))
    inside = F.sum("_n").over(Window.partitionBy("_g").orderBy("_k").rowsBetween(upto, 0)) - F.col("_n")
    off_key = (c_key.withColumn("_ok", inside).join(F.broadcast(ranges), "_g")
                    .select("_k", (F.col("_ok") + F.col("_og")).alias("_ok")))
    off_day = c_day.select("_k", "_d", (F.sum("_n").over(
        Window.partitionBy("_k").orderBy("_d").rowsBetween(upto, 0)) - F.col("_n")).alias("_od"))
    off_min = c_min.select("_k", "_d", "_mi", (F.sum("_n").over(
        Window.partitionBy("_k", "_d").orderBy("_mi").rowsBetween(upto, 0)) - F.col("_n")).alias("_om"))
    offsets = (off_min.join(off_day, ["_k", "_d"]).join(off_key, ["_k"])
                      .select("_k", "_d", "_mi", (F.col("_ok") + F.col("_od") + F.col("_om")).alias("_off"))
                      .repartition("_k", "_d", "_mi"))
    w = Window.partitionBy("_k", "_d", "_mi").orderBy(ts, *rest)
    numbered = x.withColumn("_r", F.row_number().over(w))
    return (numbered.join(offsets, ["_k", "_d", "_mi"])
                    .withColumn(name, (F.lit(start) + F.col("_off") + F.col("_r")).cast("bigint"))
                    .drop("_k", "_d", "_mi", "_r", "_off"))


DAY = "day"
ARRIVAL = "_arrival"
#: Days of a batch that are named one by one in the stored side's scan; more become at most as many ranges.
DAYS_NAMED = 366
#: Folder inside a table that keeps the largest id handed out, hidden from readers of the table.
MARKS = "_ids"


def day_ranges(days: Sequence[date], limit: int = DAYS_NAMED) -> list[tuple[date, date]]:
    """``days`` as at most ``limit`` ranges (first, last): runs of days, joined over the smallest gaps if there are more."""
    found = sorted(set(days))
    gaps = sorted(range(1, len(found)), key=lambda k: (found[k - 1] - found[k], k))[:limit - 1]
    cuts = [0, *sorted(k for k in gaps if (found[k] - found[k - 1]).days > 1), len(found)]
    return [(found[a], found[z - 1]) for a, z in zip(cuts, cuts[1:])] if found else []


def stored_days(spark, table_path: str, schema, days: Sequence[date]) -> DataFrame:
    """The stored rows of ``days``; other days' files are not listed as splits.

    The days are literals on the partition column: up to ``DAYS_NAMED`` as a list, so a stray timestamp of decades ago adds one folder
    and not all between; more as ranges that leave out the largest gaps.
    """
    table = spark.read.schema(schema).parquet(table_path)
    days = sorted(set(days))
    if len(days) <= DAYS_NAMED:
        return table.filter(F.col(DAY).isin([F.lit(d) for d in days]) if days else F.lit(False))
    return table.filter(reduce(or_, [F.col(DAY).between(F.lit(a), F.lit(z)) for a, z in day_ranges(days)]))


def append_if_absent(batch: DataFrame, table_path: str, keys: Sequence[str] = KEYS,
                     order: Sequence[str | Column] = ("event_id",), columns: Sequence[str] = COLUMNS,
                     ts: str = "timestamp", id_name: str | None = None) -> dict:
    """Append ``batch`` to the day-partitioned Parquet table at ``table_path``, INSERT-OR-IGNORE style.

    The batch is de-duplicated (first ``order`` wins), its keys are checked
    against the stored keys of its days and the new rows are appended.  The
    days of the batch are one small aggregate over the timestamps; as literals
    on the partition column they leave only those days' files in the scan.
    Re-running the same batch after a failure appends nothing twice: the step
    is idempotent.

    With ``id_name`` every new row gets an id in that column, dense from 1 over
    all loads, by (keys) within a load; see ``high_water``.  Returns how many
    distinct ``keys`` the batch had and how many rows were ``loaded``.
    """
    spark = batch.sparkSession
    fresh = keep_first(batch, list(keys), list(order)).withColumn(DAY, F.to_date(ts))
    out = fresh.select(*columns, DAY)
    ids = [T.StructField(id_name, T.LongType())] if id_name else []
    schema = T.StructType([*ids, *out.schema.fields])
    ensure_table(spark, table_path, schema)
    days = [r[0] for r in batch.select(F.to_date(ts)).filter(F.to_date(ts).isNotNull()).distinct().toLocalIterator()]
    if not days:
        return {"keys": 0, "loaded": 0}
    stored = stored_days(spark, table_path, schema, days).select(*keys, DAY, F.lit(True).alias("_stored"))
    seen = Observation()
    # observed in the stage that writes, after the last shuffle: counted once, whatever is recomputed before it
    new = (out.join(stored, [*keys, DAY], "left")
           .observe(seen, F.count(F.lit(1)).alias("keys"), F.count_if(F.col("_stored").isNull()).alias("loaded"))
           .filter(F.col("_stored").isNull()).select(*columns, DAY))
    if not id_name:
        new.write.mode("append").partitionBy(DAY).parquet(table_path)
        return dict(seen.get)
    kept = scratch_path(spark, "load")
    try:
        new.write.parquet(kept)  # the rows are counted and numbered before any of them is in the table
        if loaded := seen.get["loaded"]:
            start = high_water(spark, table_path, id_name)
            mark(spark, table_path, start + loaded, done=False)
            numbered = surrogate_id(spark.read.schema(out.schema).parquet(kept), list(keys), name=id_name, start=start)
            numbered.select(id_name, *columns, DAY).write.mode("append").partitionBy(DAY).parquet(table_path)
            mark(spark, table_path, start + loaded, done=True)
        return dict(seen.get)
    finally:
        remove_path(spark, kept)


def high_water(spark, table_path: str, id_name: str = "id") -> int:
    """The largest id in use.

    Every load leaves two marks, before it appends and after.  If the last one
    is of a load that did not finish, the ids of the table itself decide, so a
    load that is run again goes on where the table ends: neither gap nor
    repetition.  One load at a time may write to a table.
    """
    try:
        marks = spark.read.schema("high long, done boolean, at long").parquet(f"{table_path}/{MARKS}")
        last = marks.orderBy(F.desc("at")).first()
    except AnalysisException:  # no load has numbered rows here
        last = None
    if last is not None and last["done"]:
        return last["high"]
    return spark.read.schema(f"`{id_name}` long").parquet(table_path).agg(F.max(id_name)).first()[0] or 0


def mark(spark, table_path: str, high: int, done: bool) -> None:
    """Note the largest id of a load that is about to append (``done`` False) or has."""
    row = spark.createDataFrame([(high, done, time.time_ns())], "high long, done boolean, at long")
    row.coalesce(1).write.mode("append").parquet(f"{table_path}/{MARKS}")


def ensure_table(spark, table_path: str, schema) -> None:
    """Create an empty day-partitioned table at ``table_path`` if there is none (idempotent)."""
    (spark.createDataFrame([], schema).write.mode("append").partitionBy(DAY).parquet(table_path))


def load_files(spark, source: str, table_path: str, fmt: str = "parquet", schema=None,
               order: Sequence[str | Column] | None = None, ranges: Mapping[str, tuple[float, float]] | None = None,
               id_name: str | None = None) -> dict:
    """The load job: read a telemetry file set, conform it, NaN -> NULL, append new keys.

    The source is read once: rows are checked, counted and written to a
    scratch folder in one pass without a shuffle (which is removed in the
    end); the copies of a key and the stored keys are told from that.

    Without an explicit ``order``, the first copy of a key in arrival order
    wins: file time, file path, then the place in the file.  ``ranges`` names
    columns and bounds (both inclusive); a row outside, or with NULL there, is
    not loaded.  Returns what was read and what became of it: ``rows``,
    ``corrupt`` (rows that do not fit the types, CSV only), ``null_keys``,
    ``out_of_range``, ``duplicates`` (copies of a key in the batch), none of
    which is loaded, ``known`` (keys stored before) and ``loaded``; together
    they are the rows.
    """
    schema = schema or TELEMETRY
    file = [F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("path")]
    if fmt == "csv":
        # no row index in text files: the split's offset, then the order in which the split is read
        place = [F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")]
        raw = read_csv(spark, source, schema, corrupt=True, tag=F.struct(*file, *place).alias(ARRIVAL))
    else:
        place = [F.col("_metadata.row_index").alias("row")]
        raw = spark.read.format(fmt).load(source).select("*", F.struct(*file, *place).alias(ARRIVAL), F.lit(None).alias(CORRUPT))
    required = [f.name for f in schema.fields if not f.nullable]
    optional = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    typed = conform_schema(raw, optional, keep=[ARRIVAL, CORRUPT])
    sound, keyed = F.col(CORRUPT).isNull(), reduce(and_, [F.col(c).isNotNull() for c in required], F.lit(True))
    inside = reduce(and_, [F.coalesce(F.nanvl(F.col(c), F.lit(None)).between(a, z), F.lit(False)) for c, (a, z) in (ranges or {}).items()], F.lit(True))
    read = Observation()
    checked = typed.observe(
        read, F.count(F.lit(1)).alias("rows"), F.count_if(~sound).alias("corrupt"), F.count_if(sound & ~keyed).alias("null_keys"),
        F.count_if(sound & keyed & ~inside).alias("out_of_range"))
    kept = scratch_path(spark, "conformed")
    try:
        normalise_nans(checked.filter(sound & keyed & inside).drop(CORRUPT)).write.parquet(kept)
        found = dict(read.get)
        batch = spark.read.parquet(kept)
        got = append_if_absent(batch, table_path, order=list(order or [ARRIVAL]), id_name=id_name)
    finally:
        remove_path(spark, kept)
    valid = found["rows"] - found["corrupt"] - found["null_keys"] - found["out_of_range"]
    return found | {"duplicates": valid - got["keys"], "known": got["keys"] - got["loaded"], "loaded": got["loaded"]}
