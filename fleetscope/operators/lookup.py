"""Lookup of a key in a dimension table, as a join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.operators.dedup import _cols
from fleetscope.sources.size import literal_bytes

#: A dimension of at most this many bytes is sent to every executor.
BROADCAST_BYTES = 64 << 20


class DuplicateKeys(ValueError):
    """A dimension has several rows for a key; a lookup would multiply rows."""


def duplicate_keys(dim: DataFrame, key: Sequence[str], most: int = 10) -> list[tuple]:
    """Up to ``most`` keys that occur more than once, in order, with their numbers of rows."""
    again = dim.filter(_all_known(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return [tuple(r) for r in again.orderBy(*key).limit(most).collect()]


def lookup(df: DataFrame, dim: DataFrame, key: str | Sequence[str], values: Sequence[str], dim_key: str | Sequence[str] | None = None,
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with ``values`` of the row of ``dim`` that has its key; NULL for an unknown or NULL key.  No row is lost or doubled.

    The key must be unique in ``dim`` (NULL keys of it are left out): else
    ``DuplicateKeys`` names some that are not.  A dimension whose key and value
    columns measure at most ``broadcast_bytes`` is broadcast and ``df`` stays in
    place; a larger one is joined by a shuffle, in which rows with a NULL key,
    that can match nothing, take no part.
    """
    keys = [key] if isinstance(key, str) else list(key)
    theirs = keys if dim_key is None else [dim_key] if isinstance(dim_key, str) else list(dim_key)
    narrow = dim.select(*theirs, *values).filter(_all_known(theirs))
    if twice := duplicate_keys(narrow, theirs):
        raise DuplicateKeys(f"{', '.join(theirs)} is not unique: " + ", ".join(f"{t[:-1]} {t[-1]} times" for t in twice))
    small = literal_bytes(narrow) <= broadcast_bytes
    own = "_dim"
    while any(c.lower().startswith(own) for c in df.columns):
        own = "_" + own
    named = narrow.toDF(*(f"{own}_{k}" for k in range(len(theirs) + len(values))))
    match = [F.col(k) == F.col(f"{own}_{n}") for n, k in enumerate(keys)]
    found = [F.col(f"{own}_{n}").alias(v) for n, v in enumerate(values, start=len(theirs))]
    if small:
        return df.join(F.broadcast(named), match, "left").select(*_cols(df.columns), *found)
    known = df.filter(_all_known(keys)).join(named, match, "left").select(*_cols(df.columns), *found)
    nothing = [F.lit(None).cast(dim.schema[v].dataType).alias(v) for v in values]
    return known.union(df.filter(~_all_known(keys)).select(*_cols(df.columns), *nothing))


def _all_known(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])
