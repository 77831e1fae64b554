"""Column functions: seeded draws and configuration checks."""

import pytest
from pyspark.sql import functions as F

from fleetscope.functions.expr import hash_unit, key_unit, weighted_category
from fleetscope.operators import cleanse as C


def test_hash_and_key_units_deterministic_and_in_range(spark):
    df = spark.range(0, 20000).withColumn("k", F.concat(F.lit("TRN-"), F.col("id").cast("string")))
    a = df.select(hash_unit("id", 7).alias("u"), key_unit("k", "s").alias("v"))
    b = df.repartition(7).select(hash_unit("id", 7).alias("u"), key_unit("k", "s").alias("v"))
    assert a.exceptAll(b).count() == 0                      # partition-independent
    stats = a.agg(F.min("u"), F.max("u"), F.avg("u"), F.min("v"), F.max("v"), F.avg("v")).first()
    assert 0.0 <= stats[0] and stats[1] < 1.0 and 0.0 <= stats[3] and stats[4] < 1.0
    assert abs(stats[2] - 0.5) < 0.02 and abs(stats[5] - 0.5) < 0.02
    frac = a.filter(F.col("u") < 0.05).count() / 20000
    assert abs(frac - 0.05) < 0.01


def test_weighted_category_checks_and_shares(spark):
    with pytest.raises(ValueError):
        weighted_category(F.lit(0.5), ["a", "b"], [0.5, 0.6])
    with pytest.raises(ValueError):
        weighted_category(F.lit(0.5), ["a", "b"], [1.0])
    df = spark.range(0, 20000).select(weighted_category(hash_unit("id", 3), ["OK", "WARNING", "CRITICAL"],
                                                        [0.95, 0.04, 0.01]).alias("s"))
    shares = {r.s: r["count"] / 20000 for r in df.groupBy("s").count().collect()}
    assert abs(shares["OK"] - 0.95) < 0.01 and abs(shares["CRITICAL"] - 0.01) < 0.005


def test_config_checks():
    with pytest.raises(ValueError):
        C.key_factor("train_id", 1.3, 0.7, "s")
    hours = C.hour_factors(0.8, 1.2, 17)
    assert len(hours) == 24 and all(0.8 <= v < 1.2 for v in hours.values())


def test_hash_unit_negative_keys_in_range(spark):
    df = spark.range(-5000, 0).select(hash_unit("id", 11).alias("u"))
    lo, hi = df.agg(F.min("u"), F.max("u")).first()
    assert 0.0 <= lo and hi < 1.0
