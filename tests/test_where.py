"""Text predicates (F13): rows, bound values, pushdown, and what is refused."""

from datetime import datetime, timedelta

import pytest

from fleetscope.operators.where import BadPredicate, where
from tests.toy import T0, frame, row


@pytest.fixture
def telemetry(spark):
    return frame(spark, [
        row("TRN-1", 0, speed=10.0, status="OK"), row("TRN-2", 1, speed=20.0, status="CRITICAL"),
        row("TRN-3", 2, speed=None, status="OK"), row("TRN-4", 3, speed=40.0, status=None)])


def trains(df):
    return sorted(r["train_id"] for r in df.collect())


def test_values_are_bound(telemetry):
    assert trains(where(telemetry, "speed_kmh BETWEEN :low AND :high", low=10, high=20.0)) == ["TRN-1", "TRN-2"]
    assert trains(where(telemetry, "NOT (speed_kmh > :x)", x=15)) == ["TRN-1"]  # NULL is not true
    assert trains(where(telemetry, "status <=> :s", s=None)) == ["TRN-4"]
    assert trains(where(telemetry, "timestamp >= :t", t=T0 + timedelta(minutes=2))) == ["TRN-3", "TRN-4"]
    # a value is never read as SQL, and quoted text holds no markers, keywords or fields
    assert trains(where(telemetry, "status = :s", s="OK' OR '1'='1")) == []
    assert trains(where(telemetry, "status = ':s' OR status = 'select {x}' OR status = :s", s="OK")) == ["TRN-1", "TRN-3"]
    assert trains(where(telemetry, "speed_kmh::int = :x -- ten", x=10)) == ["TRN-1"]


def test_columns_stay(telemetry):
    assert where(telemetry, "true").columns == telemetry.columns
    assert trains(where(telemetry, "speed_kmh > NULL")) == []
    odd = telemetry.withColumnRenamed("status", "select")
    assert trains(where(odd, "`select` = :s", s="CRITICAL")) == ["TRN-2"]


@pytest.mark.parametrize("text, params", [
    ("", {}),
    ("speed_kmh >", {}),
    ("speed_kmh > 1) OR (true", {}),
    ("true; DROP TABLE x", {}),
    ("speed_kmh + 1", {}),
    ("NULL", {}),
    ("no_such_column = 1", {}),
    ("no_such_function(speed_kmh)", {}),
    ("count(*) > 1", {}),
    ("rank() OVER (ORDER BY speed_kmh) = 1", {}),
    ("train_id IN (SELECT train_id FROM other)", {}),
    ("EXISTS (TABLE other)", {}),
    ("speed_kmh > :low", {}),
    ("speed_kmh > 1", {"low": 1}),
    ("speed_kmh > 1 /* :low */", {"low": 1}),
])
def test_refused(telemetry, text, params):
    with pytest.raises(BadPredicate):
        where(telemetry, text, **params)


def test_reaches_the_scan(spark, telemetry, tmp_path, capsys):
    telemetry.write.parquet(str(tmp_path / "t"))
    table = spark.read.schema(telemetry.schema).parquet(str(tmp_path / "t"))
    where(table, "speed_kmh > :x AND status = :s AND timestamp >= :t", x=15, s="CRITICAL", t=datetime(2024, 1, 1)).explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line)
    assert "GreaterThan(speed_kmh,15.0)" in pushed
    assert "EqualTo(status,CRITICAL)" in pushed
    assert "GreaterThanOrEqual(timestamp" in pushed
