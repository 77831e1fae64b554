"""Measured sizes of small tables, which broadcasts are decided by."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_bytes(df: DataFrame) -> int:
    """Bytes of all values of ``df``, 8 for a number, the UTF-8 length for text: one aggregate, no estimate."""
    def width(f: T.StructField):
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(f.name), F.lit(0)) + F.lit(16)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
        return F.lit(8)

    row = reduce(add, [width(f) for f in df.schema.fields], F.lit(8)).cast("long")
    return df.agg(F.sum(row)).first()[0] or 0
