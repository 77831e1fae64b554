"""Previous-row values per key (offset-1 LAG) in which a hot key is no single task.

A plain ``lag`` over ``partitionBy(key)`` is one shuffle and one window, but sorts all rows of one key in one task: a train or
tower that carries a third of the table would serialise the job. So the keys with more than ``HOT_ROWS`` rows are counted first
(one small aggregate over the key column; at most rows / ``HOT_ROWS`` keys can be), and only their rows take the levelled way:

the lag runs per (key, time bucket), ``buckets`` being ``date_trunc`` units of the leading order column, finest first. The first
row of a bucket needs the last row of the previous non-empty bucket of its key: the last row of every bucket forms a boundary table,
read off the same window (``lead`` is absent there), and *its* previous row is found the same way one level coarser, finally by a
plain lag per key over the few coarsest buckets. One window per level; every window holds at most one bucket of one key, the rows are
shuffled once, and each boundary table is much smaller and co-partitioned with the level above it, so the large side of every join
stays in place. The answer equals the plain lag exactly.

``buckets`` given takes the levelled way for every key, ``()`` the plain lag for every key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a key from which its rows are parted by time; a window sorts at most that many rows, some 100 MB.
HOT_ROWS = 1_000_000
#: The levels for hot keys: minutes of a day, days.
HOT_BUCKETS = ("minute", "day")


def _first_bucket() -> Column:
    """Bucket of NULL timestamps: earlier than any real one (a real year-1 reading may share it:
    harmless, the rows inside a bucket are still ordered by their own timestamps, NULLs first)."""
    return F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")


def _as_list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """The keys with more than ``hot_rows`` rows, one row each; None if there are none."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*keys).toArrow()
    return df.sparkSession.createDataFrame(found) if found.num_rows else None


def previous_row(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                 cols: Sequence[str], prefix: str = "previous_",
                 buckets: Sequence[str] | None = None,
                 boundary_source: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same ``key``.

    ``order`` (ascending) should be unique within a key for a deterministic
    answer; its first column must be a timestamp unless ``buckets`` is empty.
    Previous *row*, not previous non-NULL value.  A NULL key is a key.
    ``boundary_source``: a cheaper frame with the same rows (e.g. the stored
    table ``df`` was derived from) to count the keys in and to read the bucket
    boundaries from, so those passes do not re-derive ``df``.
    """
    keys, order, cols = _as_list(key), _as_list(order), list(cols)
    if buckets is not None and not buckets:
        # on the plain columns, so that a table bucketed by the key is read in place
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select(*df.columns, *[F.lag(c).over(w).alias(prefix + c) for c in cols])
    if buckets is None:
        hot = hot_keys(df if boundary_source is None else boundary_source, keys, hot_rows)
        if hot is None:
            return previous_row(df, keys, order, cols, prefix, ())

        def part(frame: DataFrame, how: str) -> DataFrame:
            # at most rows / hot_rows keys: a broadcast of a proven size
            mark = hot.select(F.struct(*keys).alias("_hot"))
            return frame.join(F.broadcast(mark), F.struct(*[F.col(k) for k in keys]) == F.col("_hot"), how)

        bsrc = None if boundary_source is None else part(boundary_source, "left_semi")
        return (previous_row(part(df, "left_anti"), keys, order, cols, prefix, ())
                .unionByName(previous_row(part(df, "left_semi"), keys, order, cols, prefix, HOT_BUCKETS, bsrc)))
    # One struct key: struct fields compare NULL = NULL, so a NULL key is a group of its
    # own (as in a SQL window) while every join stays a plain, co-partitioned equi-join.
    # The keys travel only inside the struct (unpacked at the end), so the lag pass and the
    # boundary pass shuffle identical columns and Spark computes that shuffle once.
    used = set(order) | set(cols)

    def packed(frame: DataFrame) -> DataFrame:
        return frame.select(F.struct(*[F.col(k) for k in keys]).alias("_kk"),
                            *[c for c in frame.columns if c not in keys or c in used])

    bsrc = packed(boundary_source) if boundary_source is not None else None
    out = _previous(packed(df), ["_kk"], order, cols, list(buckets or []), level=0, boundary_source=bsrc)
    return out.select(*[F.col("_kk")[c].alias(c) if c in keys and c not in used else F.col(c)
                        for c in df.columns],
                      *[F.col(f"_prev_{c}").alias(prefix + c) for c in cols])


def _previous(df: DataFrame, keys: list, order: list, cols: list, units: list, level: int,
              boundary_source: DataFrame | None = None) -> DataFrame:
    """``df`` plus ``_prev_<c>`` for every ``c`` in ``cols``."""
    if not units:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({f"_prev_{c}": F.lag(c).over(w) for c in cols})

    b, head, tail, carry = f"_b{level}", f"_head{level}", f"_tail{level}", f"_carry{level}"
    # a NULL timestamp goes to a bucket that sorts before every real one (NULLS FIRST)
    bucket = F.coalesce(F.date_trunc(units[0], F.col(order[0])).cast("timestamp_ntz"), _first_bucket())
    w = Window.partitionBy(*keys, b).orderBy(*order)
    ends = {head: F.lag(F.lit(1)).over(w).isNull(), tail: F.lead(F.lit(1)).over(w).isNull()}
    inner = df.withColumn(b, bucket).withColumns({**{f"_prev_{c}": F.lag(c).over(w) for c in cols}, **ends})

    # Boundary table: the last row of each (key, bucket), taken from the same
    # window (same partitioning and order, so no extra shuffle or sort);
    # the whole row is carried because the value itself may be NULL.
    if boundary_source is None:
        ranked = inner
    else:
        ranked = (boundary_source.select(*keys, *dict.fromkeys([*order, *cols])).withColumn(b, bucket)
                  .withColumn(tail, ends[tail]))
    last = (ranked.filter(F.col(tail))
                  .select(*keys, b, F.struct(*[F.col(c).alias(c) for c in cols]).alias("_last")))
    # Previous non-empty bucket of the same key: the same problem one level coarser.
    prev_last = _previous(last, keys, [b], ["_last"], units[1:], level + 1)
    prev_last = prev_last.select(*keys, b, F.col("_prev__last").alias(carry)).repartition(*keys, b)

    out = inner.join(prev_last, [*keys, b], "left")
    out = out.withColumns({
        f"_prev_{c}": F.when(F.col(head), F.col(carry)[c]).otherwise(F.col(f"_prev_{c}")) for c in cols})
    return out.drop(b, head, tail, carry)
