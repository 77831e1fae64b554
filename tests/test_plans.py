"""Plan-shape assertions: pruning, pushdown, partial limits/aggregates, top-k, no Python UDFs."""

import pytest

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    from fleetscope.plans.catalog import QUERIES
    return QUERIES


# these write when they are built
EAGER = {"i03_csv_roundtrip", "i03_csv_raw_order", "i04_report_read_back", "i05_latest_snapshot", "i07_parquet_roundtrip",
         "i10_csv_first_wins", "i16_report_manifest", "i17_mart_clustered_write", "i17_mart_order", "s01_stream_load"}


def test_no_python_udf_anywhere(spark, qs):
    for k, fn in qs.items():
        if k in EAGER:
            continue
        p = plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, k


def test_topk_is_take_ordered(spark, qs):
    for k in ["r02_top_critical", "r04_temp_jumps", "r06_power_speed_ratio", "r08_chronic_failure",
              "r09_speed_signal_contrast", "r10_consumption_baseline"]:
        assert "TakeOrderedAndProject" in plan(qs[k](spark, SF)), k


def test_keep_first_has_partial_limit_before_shuffle(spark, qs):
    p = plan(qs["w06_keep_first"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_column_pruning_reaches_scan(spark, qs):
    p = plan(qs["r05_segment_blackout"](spark, SF))
    # segment, signal and network need event_id, user_id, value, props (+ ts for the key); never event_type
    read = [ln for ln in p.splitlines() if "ReadSchema" in ln][0]
    assert "event_type" not in read


def test_scan_pushes_filter(spark, qs):
    p = plan(qs["i01_scan_parquet"](spark, SF))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in p


def test_contrast_is_single_aggregate(spark, qs):
    p = plan(qs["r09_speed_signal_contrast"](spark, SF))
    assert "Join" not in p.replace("BroadcastNestedLoopJoin", "")


def test_no_cross_joins(spark, qs):
    # one-row aggregates enter as scalar subqueries, never as cartesian products
    for k, fn in qs.items():
        if k in EAGER:
            continue
        p = plan(fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k
    assert "Subquery" in plan(qs["r10_consumption_baseline"](spark, SF))


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_baseline_reuses_per_train_shuffle(spark, qs):
    p = _final_plan(qs["r10_consumption_baseline"](spark, SF))
    assert "ReusedExchange" in p and "Subquery" in p


def _row_exchanges(p):
    """Hash exchanges of a final plan that carry rows (the boundary tables are exchanges above an aggregate or a rank filter)."""
    import re
    return [x for x in re.findall(r"Exchange hashpartitioning\(([^\n]*?), \d+\)", p)]


def test_lag_takes_two_row_shuffles(spark, qs):
    """One for the de-duplication, one on the key; one window over the rows and no join where no key is hot."""
    import re
    for k, key in (("r04_temp_jumps", "train_id"), ("r07_signal_drops", "cell_tower_id")):
        p = _final_plan(qs[k](spark, SF))
        parts = re.findall(r"Window \[lag\(.*?\], \[([^\]]*)\], \[", p)
        assert len(parts) == 1 and key in parts[0] and "Join" not in p, k
        # the lag on trains reads the shuffle of the de-duplication's result, which is on (train, time), once more by train
        assert len(_row_exchanges(p)) == 2, (k, _row_exchanges(p))


def test_quality_steps_need_no_join(spark, qs):
    for k in ("m08_quality_flags", "m09_speed_range"):
        assert "Join" not in plan(qs[k](spark, SF)), k


def test_insert_if_absent_is_one_shuffle(spark, qs):
    p = _final_plan(qs["i10_insert_if_absent"](spark, SF))
    assert "Join" not in p


def test_load_reads_only_the_days_of_the_batch(spark, tmp_path):
    """The stored side of a two-day batch has its days as literals on the partition column, and lists those days' files only."""
    from datetime import date

    from fleetscope.sources.fixture import train_telemetry
    from fleetscope.sources.ingest import append_if_absent, stored_days
    t = train_telemetry(spark, SF)
    path = str(tmp_path / "table")
    append_if_absent(t, path)
    schema = spark.read.parquet(path).schema
    stored = stored_days(spark, path, schema, [date(2024, 1, 3), date(2024, 1, 4)])
    p = plan(stored)
    assert "PartitionFilters: [day" in p and "2024-01-03" in p and "2024-01-04" in p
    stored.collect()
    assert {r[0].rsplit("/", 2)[1] for r in stored.selectExpr("_metadata.file_path").distinct().collect()} <= {
        "day=2024-01-03", "day=2024-01-04"}


def test_single_partition_only_above_bounded_tables(spark, qs):
    """A window over one partition may only stand on an aggregate: key ranges (i09), histogram buckets (c19)."""
    for k in ("i09_surrogate_id", "c19_sample_exact"):
        p = _final_plan(qs[k](spark, SF))
        for part in p.split("Exchange SinglePartition")[1:]:
            head = "".join(part.splitlines(keepends=True)[:8])
            assert "HashAggregate" in head or "TakeOrdered" in head or "BroadcastHashJoin" in head, (k, head)
