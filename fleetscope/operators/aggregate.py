"""Grouped aggregates used by the reports.

Every aggregate here is algebraic (sum / count / count_if / avg), so Spark plans a
partial aggregate before the shuffle: a hot key is reduced on the map side
and each key costs one row per map task in the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.expr import col_, round_to, safe_div


def _keys(k) -> list:
    return [k] if isinstance(k, (str, Column)) else list(k)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k -> ``TakeOrderedAndProject`` (per-partition top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def flag_rate(df: DataFrame, keys, cond: Column, name: str, digits: int | None = 4,
              half_even: bool = False) -> DataFrame:
    """Share of rows per key where ``cond`` is TRUE (NULL counts as FALSE)."""
    agg = df.groupBy(*_keys(keys)).agg(
        F.count_if(F.coalesce(cond, F.lit(False))).alias("_hit"), F.count(F.lit(1)).alias("_n"))
    return agg.select(*_keys(keys), round_to(safe_div("_hit", "_n"), digits, half_even).alias(name))


def ratio_of_sums(df: DataFrame, keys, num: str, den: str, num_name: str, den_name: str,
                  ratio_name: str = "ratio", digits: int | None = 2, sum_digits: int | None = None,
                  half_even: bool = False) -> DataFrame:
    """``sum(num)``, ``sum(den)`` and ``sum(num)/nullif(sum(den), 0)`` per key."""
    agg = df.groupBy(*_keys(keys)).agg(F.sum(num).alias("_sn"), F.sum(den).alias("_sd"))
    return agg.select(
        *_keys(keys),
        round_to("_sn", sum_digits).alias(num_name),
        round_to("_sd", sum_digits).alias(den_name),
        round_to(safe_div("_sn", "_sd"), digits, half_even).alias(ratio_name))


def contrast(df: DataFrame, keys, value: str, low: Column, high: Column,
             low_name: str, high_name: str, delta_name: str,
             digits: int = 2, round_first: bool = False) -> DataFrame:
    """Per key: mean of ``value`` where ``low`` holds vs where ``high`` holds, and high - low.

    One pass with conditional averages (no self-join); only keys with both
    means non-NULL are kept.  ``round_first`` rounds each mean half-even and
    subtracts the rounded values (dataframe-library semantics); otherwise the
    difference of the exact means is rounded half-up (SQL semantics).
    """
    src = df.filter(low | high)  # rows in neither band never reach the shuffle
    agg = src.groupBy(*_keys(keys)).agg(
        F.avg(F.when(low, col_(value))).alias("_lo"), F.avg(F.when(high, col_(value))).alias("_hi"))
    agg = agg.dropna(subset=["_lo", "_hi"])
    if round_first:
        lo, hi = F.bround("_lo", digits), F.bround("_hi", digits)
        return agg.select(*_keys(keys), lo.alias(low_name), hi.alias(high_name),
                          (hi - lo).alias(delta_name))
    return agg.select(*_keys(keys), F.round("_lo", digits).alias(low_name),
                      F.round("_hi", digits).alias(high_name),
                      F.round(F.col("_hi") - F.col("_lo"), digits).alias(delta_name))


def delta_from_baseline(df: DataFrame, keys, num: str, den: str) -> DataFrame:
    """Per key ``avg(num)/avg(den)`` minus the same ratio over all rows.

    Returns keys, ``avg_num``, ``avg_den``, ``ratio``, ``baseline``, ``delta``.
    The global means are derived from the per-key partial sums and counts
    (one scan; the per-key exchange is reused) and enter as a scalar
    subquery: one value, no join.
    """
    part = df.groupBy(*_keys(keys)).agg(
        F.sum(num).alias("_sn"), F.count(num).alias("_cn"),
        F.sum(den).alias("_sd"), F.count(den).alias("_cd"))
    baseline = part.agg(
        safe_div(safe_div(F.sum("_sn"), F.sum("_cn")), safe_div(F.sum("_sd"), F.sum("_cd")))).scalar()
    # try_divide (NULL on a zero count) keeps this branch's partial aggregate
    # identical to the subquery's, so the per-key shuffle is computed once.
    out = part.select(*_keys(keys), F.try_divide("_sn", "_cn").alias("avg_num"),
                      F.try_divide("_sd", "_cd").alias("avg_den"), baseline.alias("baseline"))
    out = out.withColumn("ratio", safe_div("avg_num", "avg_den"))
    return out.withColumn("delta", F.col("ratio") - F.col("baseline"))


def value_counts(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """Rows per distinct key (``groupBy().count()``)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))
