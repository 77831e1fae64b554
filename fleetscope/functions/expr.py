"""Column expressions used across the reports, the mart and the cleansing steps.

All of them are built-in Catalyst expressions: no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope.schema import SPEED_EDGES, SPEED_LABELS

__all__ = [
    "col_", "dbl", "hour_text", "hour_int", "minute_int", "date_key", "time_key",
    "seconds_between", "speed_band", "flag", "blackout", "clip", "safe_div",
    "nan_to_null", "hash_unit", "weighted_category", "integer_jitter", "map_lookup",
    "round_to", "key_unit", "normal_noise",
]


def col_(c: str | Column) -> Column:
    """A column name or Column, as a Column."""
    return F.col(c) if isinstance(c, str) else c


def dbl(x: float) -> Column:
    """A DOUBLE literal (a bare ``1.0`` in Spark SQL is DECIMAL)."""
    return F.lit(float(x))


def hour_text(ts: str | Column = "timestamp") -> Column:
    """Hour of day as two-digit text '00'..'23'."""
    return F.date_format(col_(ts), "HH")


def hour_int(ts: str | Column = "timestamp") -> Column:
    """Hour of day as INT 0..23."""
    return F.hour(col_(ts))


def minute_int(ts: str | Column = "timestamp") -> Column:
    """Minute of hour as INT 0..59."""
    return F.minute(col_(ts))


def date_key(ts: str | Column = "timestamp") -> Column:
    """yyyymmdd as INT, by arithmetic (no string formatting per row)."""
    t = col_(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def time_key(ts: str | Column = "timestamp") -> Column:
    """Minute of day (hour*60 + minute) as INT."""
    t = col_(ts)
    return (F.hour(t) * 60 + F.minute(t)).cast("int")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in (fractional) seconds as DOUBLE; NULL if either is NULL."""
    s = F.unix_micros(col_(start).cast("timestamp"))
    e = F.unix_micros(col_(end).cast("timestamp"))
    return (e - s) / dbl(1_000_000)


def speed_band(c: str | Column = "speed_kmh", edges: Sequence[float] = SPEED_EDGES,
               labels: Sequence[str] = SPEED_LABELS, null_to_last: bool = True) -> Column:
    """Right-closed bands: ``x <= e0 -> l0``, ``x <= e1 -> l1`` ... else the last label.

    ``null_to_last=True`` is the SQL CASE (a NULL falls through to ELSE);
    ``False`` is interval binning, where a NULL stays NULL.
    """
    x = col_(c)
    expr = None
    for e, lab in zip(edges, labels):
        cond = x <= F.lit(e)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    last = F.lit(labels[len(edges)])
    if null_to_last:
        return expr.otherwise(last)
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(last))


def flag(cond: Column) -> Column:
    """1 where ``cond`` is TRUE, else 0 (NULL counts as 0)."""
    return F.when(cond, 1).otherwise(0)


def blackout(signal: str | Column = "signal_strength_dbm", network: str | Column = "network_type",
             threshold: float = -100.0) -> Column:
    """Weak signal or no network."""
    return (col_(signal) < F.lit(threshold)) | (col_(network) == F.lit("OFFLINE"))


def clip(c: str | Column, lo: float | None, hi: float | None) -> Column:
    """Clamp to [lo, hi]; a NULL stays NULL (greatest/least alone would skip it)."""
    x = col_(c)
    y = x
    if hi is not None:
        y = F.least(F.lit(hi), y)
    if lo is not None:
        y = F.greatest(F.lit(lo), y)
    return F.when(x.isNull(), x).otherwise(y)


def safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with NULL instead of an error when ``den`` is 0."""
    return col_(num).cast("double") / F.nullif(col_(den).cast("double"), dbl(0))


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL (other values unchanged)."""
    x = col_(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def hash_unit(key: str | Column, salt: int, modulus: int = 10000) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from an integer key.

    ``(pmod(key, 100003) * 7919 + salt) % modulus / modulus`` (positive modulo,
    so negative keys draw in range too): independent of partitioning and task
    retries, so a re-executed task draws the same rows, and expressible in any
    SQL dialect for the oracle.
    """
    k = F.pmod(col_(key).cast("bigint"), F.lit(100003))
    return ((k * 7919 + salt) % modulus) / dbl(modulus)


def weighted_category(u: Column, values: Sequence[str], probs: Sequence[float],
                      tol: float = 1e-9) -> Column:
    """Pick ``values[i]`` when ``u`` falls in the i-th cumulative-probability slot."""
    if len(values) != len(probs) or not values:
        raise ValueError("values and probs must have the same, non-zero length")
    if abs(sum(probs) - 1.0) > tol:
        raise ValueError(f"probabilities must sum to 1, got {sum(probs)}")
    expr, acc = None, 0.0
    for v, p in zip(values[:-1], probs[:-1]):
        acc += p
        expr = F.when(u < dbl(acc), v) if expr is None else expr.when(u < dbl(acc), v)
    return F.lit(values[-1]) if expr is None else expr.otherwise(values[-1])


def integer_jitter(u: Column, lo: int, hi: int) -> Column:
    """Integer in [lo, hi) from a uniform ``u`` in [0, 1)."""
    return (F.floor(u * (hi - lo)) + lo).cast("int")


def map_lookup(c: str | Column, mapping: dict) -> Column:
    """Literal map lookup (small fixed dictionaries only); unknown key -> NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), col_(c)) if pairs else F.lit(None)


def round_to(c: str | Column, digits: int | None, half_even: bool = False) -> Column:
    """Round half-up (SQL) or half-even (dataframe library) to ``digits``; None = unchanged."""
    if digits is None:
        return col_(c)
    return F.bround(col_(c), digits) if half_even else F.round(col_(c), digits)


def key_unit(key: str | Column, salt: str = "", modulus: int = 10000) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from any (string) key.

    First 32 bits of ``md5(salt || key)``: a pure function of the key, so a
    per-key draw needs no dimension table, no join and no shuffle, and a
    re-executed task draws the same value.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.lit(salt), col_(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return (h % modulus) / dbl(modulus)


def normal_noise(u1: Column, u2: Column, mean: float, sd: float, modulus: int = 10000) -> Column:
    """Gaussian draw from two uniforms (Box-Muller); ``u1`` is shifted into (0, 1]."""
    v1 = (u1 * modulus + 1) / dbl(modulus + 1)
    z = F.sqrt(F.lit(-2.0) * F.log(v1)) * F.cos(F.lit(2 * 3.141592653589793) * u2)
    return F.lit(mean) + F.lit(sd) * z
