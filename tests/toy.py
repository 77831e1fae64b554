"""Toy-row builders for unit tests (3-10 literal rows each)."""

from datetime import datetime, timedelta

from fleetscope.schema import TELEMETRY

T0 = datetime(2024, 1, 1, 8, 0, 0)


def row(train="TRN-1", minutes=0.0, temp=60.0, status="OK", speed=100.0, signal=-70.0, tower="TWR-1",
        power=500.0, network="4G", segment="SEG-A", lat=45.4, lon=9.1):
    return (train, T0 + timedelta(minutes=minutes), temp, status, speed, lat, lon, signal, tower, power,
            network, segment)


def frame(spark, rows, with_id=False):
    df = spark.createDataFrame(rows, TELEMETRY)
    if with_id:
        from pyspark.sql import functions as F
        df = df.withColumn("event_id", F.monotonically_increasing_id())
    return df
