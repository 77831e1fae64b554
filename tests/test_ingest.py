"""Keep-first, insert-if-absent, surrogate ids and cleansing invariants."""

from pyspark.sql import functions as F

from fleetscope.operators.dedup import keep_first
from fleetscope.sources.ingest import conform_schema, insert_if_absent, normalise_nans, surrogate_id
from fleetscope.schema import COLUMNS
from toy import frame, row


def test_keep_first_first_wins_and_null_keys_skipped(spark):
    rows = [row(train="A", temp=1.0), row(train="A", temp=2.0), row(train=None, temp=3.0), row(train="B")]
    df = frame(spark, [r for r in rows if r[0] is not None], with_id=True)
    out = {r.train_id: r.temp_celsius for r in keep_first(df, ["train_id", "timestamp"], ["event_id"]).collect()}
    assert out == {"A": 1.0, "B": 60.0}


def test_insert_if_absent_idempotent_and_first_writer_wins(spark):
    target = frame(spark, [row(train="A", temp=1.0)])
    batch = frame(spark, [row(train="A", temp=9.0), row(train="B", temp=2.0), row(train="B", temp=3.0)],
                  with_id=True)
    once = insert_if_absent(target, batch)
    twice = insert_if_absent(once, batch)
    got = sorted((r.train_id, r.temp_celsius) for r in twice.collect())
    assert got == [("A", 1.0), ("B", 2.0)]
    assert once.count() == twice.count() == 2


def test_insert_skips_null_keys(spark):
    from pyspark.sql import types as T
    target = frame(spark, [row(train="A")])
    schema = T.StructType([f if f.name != "train_id" else T.StructField("train_id", T.StringType(), True)
                           for f in target.schema.fields])
    batch = spark.createDataFrame([row(train=None, minutes=5)], schema).withColumn("event_id", F.lit(1))
    assert insert_if_absent(target, batch).count() == 1


def test_surrogate_ids_dense(spark):
    from pyspark.sql import Window
    # several readings per minute, several minutes per day, several days, uneven keys
    rows = [row(train=f"T{i % 7}", minutes=(i * 97) / 13 + (i % 3) * 1440) for i in range(300)]
    df = frame(spark, rows).dropDuplicates(["train_id", "timestamp"]).repartition(5)
    n = df.count()
    out = surrogate_id(df, ["train_id", "timestamp"])
    assert sorted(r.id for r in out.collect()) == list(range(1, n + 1))
    want = df.withColumn("id", F.row_number().over(Window.orderBy("train_id", "timestamp")).cast("bigint"))
    got = sorted((r.id, r.train_id, r.timestamp) for r in out.collect())
    assert got == sorted((r.id, r.train_id, r.timestamp) for r in want.collect())


def test_conform_and_nan(spark):
    df = frame(spark, [row(temp=float("nan")), row(minutes=1)])
    out = normalise_nans(conform_schema(df)).collect()
    assert out[0].temp_celsius is None and list(out[0].asDict()) == COLUMNS


def test_scale_conf_sizes():
    from fleetscope.session import scale_conf
    big = scale_conf(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 111_759
    small = scale_conf(10 * 2**20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_cleansing_preserves_rows(spark):
    from fleetscope.operators import cleanse as C
    df = frame(spark, [row(minutes=i, temp=float(i * 40), speed=float(i * 35)) for i in range(12)], with_id=True)
    n = df.count()
    steps = [
        lambda d: C.clip_columns(d, {"temp_celsius": (0.0, 120.0)}),
        lambda d: C.scale_by_key(d, "speed_kmh", "train_id", 0.7, 1.3, "s"),
        lambda d: C.scale_by_hour(d, "speed_kmh", C.hour_factors(0.8, 1.2, 1)),
        lambda d: C.offset_by_segment(d, "signal_strength_dbm", {"SEG-A": 0.0, "SEG-B": -10.0}),
        lambda d: C.overwrite_fraction(d, "temp_celsius", None, 0.5, "event_id", 3),
        lambda d: C.overwrite_fraction(d, "temp_celsius", 999.0, 0.5, "event_id", 4),
    ]
    for st in steps:
        assert st(df).count() == n
    dup = C.inject_duplicates(df, 0.5, "event_id", 5)
    assert n <= dup.count() <= 2 * n
    assert dup.distinct().count() == n


def test_cli_load_reports_mart_end_to_end(spark, tmp_path):
    """The three jobs on paths: load twice (idempotent), reports, mart."""
    from fleetscope.__main__ import main
    from fleetscope.sources.fixture import raw_telemetry
    src = str(tmp_path / "raw")
    raw_telemetry(spark, "/root/testdata/sf0.001").drop("event_id").write.parquet(src)
    table = str(tmp_path / "table")
    main(["load", src, table])
    main(["load", src, table])
    loaded = spark.read.parquet(table)
    assert loaded.count() == 1000 == loaded.select("train_id", "timestamp").distinct().count()
    main(["reports", table, str(tmp_path / "reports")])
    man = spark.read.option("header", True).csv(str(tmp_path / "reports" / "_manifest")).collect()
    assert len(man) == 11 and all(r.status in ("ok", "empty") for r in man)
    main(["reports", table, str(tmp_path / "few"), "--limit", "300", "--where", "speed_kmh > :v AND status = :s", "--param", "v", "20", "--param", "s", "OK"])
    few = {r.report: r.status for r in spark.read.option("header", True).csv(str(tmp_path / "few" / "_manifest")).collect()}
    assert len(few) == 11 and few["top_critical"] == "empty" and few["hourly_speed"] == "ok"
    main(["mart", src, str(tmp_path / "mart"), "--scratch", str(tmp_path / "scratch")])
    assert spark.read.parquet(str(tmp_path / "mart")).count() == 1000
    assert not list((tmp_path / "scratch").iterdir())  # the job removes what it kept


def test_load_keeps_first_copy_in_file_order(spark, tmp_path):
    """Two copies of a key with different payloads in one file: the earlier row wins."""
    from fleetscope.sources.ingest import load_files
    rows = [row(train="A", temp=2.0), row(train="A", temp=1.0), row(train="B", minutes=1, temp=5.0)]
    src = str(tmp_path / "src")
    frame(spark, rows).coalesce(1).write.parquet(src)
    load_files(spark, src, str(tmp_path / "t"))
    got = {r.train_id: r.temp_celsius for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == {"A": 2.0, "B": 5.0}


def test_surrogate_ids_keep_null_keys(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(None, 1), ("A", 2), ("A", None), ("B", 3), (None, None)],
                               "k string, m int").withColumn(
        "ts", F.timestamp_add("MINUTE", F.col("m"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    out = surrogate_id(df.select("k", "ts"), ["k", "ts"])
    want = df.select("k", "ts").withColumn("id", F.row_number().over(Window.orderBy("k", "ts")).cast("bigint"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_load_raw_csv_in_another_column_order(spark, tmp_path):
    """15 columns, other order: all rows load; corrupt and keyless rows are counted; the first row of a key stays."""
    from fleetscope.sources.ingest import load_files
    src = tmp_path / "raw.csv"
    head = "cell_tower_id,hour_noise,train_id,timestamp,temp_celsius,status,speed_kmh,latitude,longitude,signal_strength_dbm,"
    head += "power_consumption_kw,network_type,line_segment,speed_modifier,signal_malus"
    line = "TWR-1,1.0,{},{},{},OK,100.0,45.0,9.0,-70.0,500.0,4G,SEG-A,1.0,0.0"
    rows = [line.format("A", "2024-01-01 08:00:00", "90.0"), line.format("A", "2024-01-01 08:00:00", "10.0"),
            line.format("B", "2024-01-02 08:00:00", "20.0"), line.format("C", "2024-01-02 08:00:00", "warm"),
            line.format("", "2024-01-02 09:00:00", "20.0")]
    src.write_text("\n".join([head, *rows]) + "\n")
    for _ in range(2):
        seen = load_files(spark, str(src), str(tmp_path / "t"), fmt="csv")
        assert {k: seen[k] for k in ("rows", "corrupt", "null_keys", "out_of_range", "duplicates")} == {
            "rows": 5, "corrupt": 1, "null_keys": 1, "out_of_range": 0, "duplicates": 1}
        assert seen["known"] + seen["loaded"] == 2
    got = {r.train_id: (r.temp_celsius, r.cell_tower_id) for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == {"A": (90.0, "TWR-1"), "B": (20.0, "TWR-1")}


def test_csv_first_wins_writes_no_single_file(spark, tmp_path, monkeypatch):
    """The rows are dealt over several files, each key's two rows into one of them, the first rows before the later ones."""
    import csv
    from fleetscope.plans.catalog import QUERIES
    from fleetscope.sources import files
    from fleetscope.sources.fixture import EVENTS_SCHEMA, train_telemetry
    (spark.range(500).selectExpr(
        "id AS event_id", "CAST(timestamp_seconds(1705300000 + id % 450 * 977) AS TIMESTAMP_NTZ) AS ts", "id % 9 AS user_id",
        "'error' AS event_type", "CAST(id % 70 AS DOUBLE) AS value", """concat('{"k": ', id % 100, '}') AS props""")
        .select(*EVENTS_SCHEMA.fieldNames()).write.parquet(str(tmp_path / "events.parquet")))
    monkeypatch.setattr(files, "scratch_path", lambda s, name: str(tmp_path / name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = QUERIES["i10_csv_first_wins"](spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = train_telemetry(spark, str(tmp_path)).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    found = []
    for path in (tmp_path / "csv-load" / "raw").glob("*.csv"):
        with open(path, newline="") as f:
            found.append([(r["train_id"], r["timestamp"], r["status"] == "AGAIN") for r in csv.DictReader(f)])
    found = [rows for rows in found if rows]
    assert len(found) > 3 and sum(map(len, found)) == 2 * want.count()
    for rows in found:
        assert [again for *_, again in rows] == [False] * (len(rows) // 2) + [True] * (len(rows) // 2)
        assert [r[:2] for r in rows[:len(rows) // 2]] == [r[:2] for r in rows[len(rows) // 2:]]


def test_csv_without_a_column_is_an_error(spark, tmp_path):
    import pytest

    from fleetscope.schema import TELEMETRY
    from fleetscope.sources.files import read_csv
    (tmp_path / "x.csv").write_text("train_id,timestamp\nA,2024-01-01 08:00:00\n")
    with pytest.raises(ValueError, match="temp_celsius"):
        read_csv(spark, str(tmp_path / "x.csv"), TELEMETRY)


def test_ids_continue_from_the_stored_maximum(spark):
    df = frame(spark, [row(train="A"), row(train="B")])
    assert sorted(r.id for r in surrogate_id(df, ["train_id", "timestamp"], start=40).collect()) == [41, 42]


def test_sample_is_exact_with_few_and_many_hash_buckets(spark):
    from fleetscope.operators import cleanse as C
    df = spark.range(20_000)
    for frac in (0.0, 0.0001, 0.05, 0.5, 1.0):
        got = C.sample_exact(df, frac, "id", "s", ["id"])
        want = {r[0] for r in df.orderBy(C.row_hash("id", "s"), "id").limit(round(20_000 * frac)).collect()}
        assert {r.id for r in got.collect()} == want and got.count() == len(want)


def test_cli_newest_snapshot(spark, tmp_path):
    from fleetscope.__main__ import main
    folder = tmp_path / "data"
    frame(spark, [row(train="OLD")]).write.parquet(str(folder / "telemetry_b.parquet"))
    frame(spark, [row(train=f"T{i}") for i in range(9)]).repartition(3).write.parquet(str(folder / "telemetry_a.parquet"))
    main(["load", str(folder), str(tmp_path / "t"), "--newest", "telemetry"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 9
    main(["mart", str(folder), str(tmp_path / "m"), "--newest", "telemetry", "--scratch", str(tmp_path / "s")])
    assert spark.read.parquet(str(tmp_path / "m")).count() == 9


def test_a_stray_day_adds_one_folder_to_what_a_load_reads(spark, tmp_path):
    """Stored: 40 days; the batch: one of them and a reading of 1970. The load lists the files of two days, not of all between."""
    from datetime import date

    from fleetscope.sources.ingest import append_if_absent, stored_days
    path = str(tmp_path / "t")
    append_if_absent(frame(spark, [row(train="A", minutes=1440 * k) for k in range(40)], with_id=True), path)
    append_if_absent(frame(spark, [row(train="Z")], with_id=True).withColumn("timestamp", F.lit("1970-01-01").cast("timestamp_ntz")), path)
    first = frame(spark, [row()]).select(F.to_date("timestamp")).first()[0]
    days = [first, date(1970, 1, 1)]
    stored = stored_days(spark, path, spark.read.parquet(path).schema, days)
    read = {r[0].rsplit("/", 2)[1] for r in stored.selectExpr("_metadata.file_path").collect()}
    assert read == {f"day={first}", "day=1970-01-01"} and len(stored.inputFiles()) >= 41  # the table's files; the scan lists two
    plan = stored._jdf.queryExecution().executedPlan()
    stored.collect()
    assert "PartitionFilters: [day" in plan.toString()
    seen = append_if_absent(frame(spark, [row(train="A"), row(train="B"), row(train="B")], with_id=True), path)
    assert seen == {"keys": 2, "loaded": 1}


def test_many_days_become_ranges_that_leave_out_the_largest_gaps(spark, tmp_path, monkeypatch):
    from datetime import date, timedelta

    from fleetscope.sources import ingest
    d = [date(2024, 1, 1) + timedelta(k) for k in (0, 1, 2, 10, 11, 400, 401, 403)]
    assert ingest.day_ranges(d, 10) == [(d[0], d[2]), (d[3], d[4]), (d[5], d[6]), (d[7], d[7])]
    assert ingest.day_ranges(d, 2) == [(d[0], d[4]), (d[5], d[7])] and ingest.day_ranges(d, 1) == [(d[0], d[7])] and ingest.day_ranges([]) == []
    monkeypatch.setattr(ingest, "DAYS_NAMED", 2)
    path = str(tmp_path / "t")
    rows = [row(train="A", minutes=1440 * k) for k in (0, 1, 2, 10, 11, 400)]
    ingest.append_if_absent(frame(spark, rows, with_id=True), path)
    assert ingest.append_if_absent(frame(spark, [*rows, row(train="B", minutes=14400)], with_id=True), path) == {"keys": 7, "loaded": 1}


def test_ids_are_dense_over_loads_replays_and_a_broken_load(spark, tmp_path, monkeypatch):
    from fleetscope.sources import ingest
    path = str(tmp_path / "t")
    one = frame(spark, [row(train=f"T{k % 3}", minutes=k) for k in range(20)], with_id=True)
    two = frame(spark, [row(train=f"T{k % 5}", minutes=k) for k in range(30)], with_id=True)
    three = frame(spark, [row(train="X", minutes=k) for k in range(4)], with_id=True)
    ids = lambda: sorted(r.id for r in spark.read.parquet(path).collect())
    for batch, n in ((one, 20), (one, 20), (two, None), (one, None)):
        ingest.append_if_absent(batch, path, id_name="id")
        assert ids() == list(range(1, len(ids()) + 1)) and (n is None or len(ids()) == n)
    before = {(r.id, r.train_id, r.timestamp) for r in spark.read.parquet(path).collect()}
    for breaks_at in (False, True):  # the load stops after the first mark, before and after its rows are in
        def broken(spark, table_path, high, done, real=ingest.mark, at=breaks_at):
            if done:
                raise RuntimeError("lost")
            real(spark, table_path, high, done)
            if not at:
                raise RuntimeError("lost")
        with monkeypatch.context() as m:
            m.setattr(ingest, "mark", broken)
            try:
                ingest.append_if_absent(three if breaks_at else three.limit(2), path, id_name="id")
            except RuntimeError:
                pass
    ingest.append_if_absent(frame(spark, [row(train="Y")], with_id=True), path, id_name="id")
    assert ids() == list(range(1, len(ids()) + 1)) and len(ids()) == len(before) + 5
    assert before <= {(r.id, r.train_id, r.timestamp) for r in spark.read.parquet(path).collect()}


def test_load_reads_its_source_once_and_counts_what_it_rejects(spark, tmp_path):
    from fleetscope.sources.files import scratch_path
    from fleetscope.sources.ingest import load_files
    src, table = str(tmp_path / "src"), str(tmp_path / "t")
    rows = [row(train="A", temp=10.0), row(train="A", temp=11.0), row(train="B", temp=500.0), row(train="C", temp=None), row(train="D", temp=float("nan")),
            row(train="E", temp=120.0), row(train="F", temp=0.0)]
    frame(spark, rows).coalesce(1).write.parquet(src)
    ranges = {"temp_celsius": (0.0, 120.0)}
    want = {"rows": 7, "corrupt": 0, "null_keys": 0, "out_of_range": 3, "duplicates": 1, "known": 0, "loaded": 3}
    assert load_files(spark, src, table, ranges=ranges, id_name="id") == want
    assert load_files(spark, src, table, ranges=ranges, id_name="id") == want | {"known": 3, "loaded": 0}
    assert sorted((r.id, r.train_id, r.temp_celsius) for r in spark.read.parquet(table).collect()) == [(1, "A", 10.0), (2, "E", 120.0), (3, "F", 0.0)]
    import os
    scratch = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    assert not [x for x in os.listdir(scratch) if x.startswith(("conformed", "load-"))]  # the job removes what it kept
