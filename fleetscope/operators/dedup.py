"""Keep-first de-duplication on a key subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               skip_null_keys: bool = True) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (ascending).

    ``row_number() == 1`` over ``partitionBy(keys)``: Spark plans it as a
    ``WindowGroupLimit`` with a *partial* limit before the shuffle, so a key
    with millions of copies is collapsed to one row per input split before it
    is exchanged, and columns the caller never reads are pruned down to the
    scan.  ``order`` should make the survivor unique (a tie-break column).
    Rows with a NULL key are dropped when ``skip_null_keys`` (the load's
    NOT NULL rule).
    """
    keys = list(keys)
    src = df
    if skip_null_keys:
        cond = None
        for k in keys:
            cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
        src = src.filter(cond)
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return src.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-row frame: rows, distinct keys and removed copies (``rows - distinct``)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("rows_in"),
        F.count(F.lit(1)).cast("bigint").alias("rows_out"),
        (F.sum("_n") - F.count(F.lit(1))).cast("bigint").alias("duplicates_removed"),
    )
