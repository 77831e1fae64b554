"""The Spark SQL report path equals the DataFrame path."""

from fleetscope.plans import reports as R
from fleetscope.plans.sql_reports import SQL_REPORTS, run_named
from fleetscope.sources.fixture import train_telemetry

SF = "/root/testdata/sf0.001"


def test_sql_reports_equal_dataframe_reports(spark):
    t = train_telemetry(spark, SF)
    assert set(SQL_REPORTS) == set(R.REPORTS)
    for name, fn in R.REPORTS.items():
        digits = {"digits": 6} if "digits" in SQL_REPORTS[name][1] else {}
        a = run_named(spark, name, t, **digits)
        b = fn(t, **({"sum_digits": 6} if name == "power_speed_ratio" else digits))
        assert a.columns == b.columns, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_sql_parameters_bind(spark):
    t = train_telemetry(spark, SF)
    loose = run_named(spark, "chronic_failure", t, min_share=0.0).count()
    strict = run_named(spark, "chronic_failure", t, min_share=0.5).count()
    assert loose >= strict
