"""Sinks and jobs: year replace (vanished month), atomic replace, namespaces, bucketing,
ingest/backfill/refresh, stream."""

import datetime as dt
import gzip

import pytest
from conftest import obs_rows, plan_text
from pyspark.sql import functions as F

from wxstar.operators import models
from wxstar.plans import jobs
from wxstar.schemas import RAW_STATIONS_SCHEMA
from wxstar.sinks import parquet as sinks
from wxstar.sources.files import read_observations, read_station_days


def _year_rows(year, months):
    return [("CA000000001", f"{year}{m:02d}15", "TMAX", "100", None, None, "S", None) for m in months]


def _write_year(tmp_path, year, months):
    p = tmp_path / "src"
    p.mkdir(exist_ok=True)
    with gzip.open(p / f"{year}.csv.gz", "wt") as f:
        for r in _year_rows(year, months):
            f.write(",".join("" if v is None else v for v in r) + "\n")
    return str(p)


def _months(spark, path, year):
    return sorted(r.month for r in read_station_days(spark, path).filter(f"year = {year}").select("month").distinct().collect())


def test_rerun_without_february_removes_it(spark, tmp_path):
    src = _write_year(tmp_path, 2024, [1, 2, 3])
    out = str(tmp_path / "out")
    clean, _ = jobs.ingest_year(spark, src, out, 2024)
    assert _months(spark, clean, 2024) == ["01", "02", "03"]
    _write_year(tmp_path, 2024, [1, 3])
    jobs.ingest_year(spark, src, out, 2024)
    assert _months(spark, clean, 2024) == ["01", "03"]


def test_dynamic_overwrite_alone_would_leave_month_stale(spark, tmp_path):
    out = str(tmp_path / "dyn")
    sd = lambda months: jobs.transform_observations(
        jobs.split_by_quality(jobs.prepare_observations(obs_rows(spark, _year_rows(2024, months))))[0])
    sinks.write_partitioned(sd([1, 2]), out)
    sd([1]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(out)
    assert _months(spark, out, 2024) == ["01", "02"]  # the trap replace_years avoids
    sinks.write_partitioned(sd([1]), out)  # the sink's own write doesn't follow the session's mode
    assert _months(spark, out, 2024) == ["01"]


def test_replace_years_leaves_other_years(spark, tmp_path):
    src = _write_year(tmp_path, 2023, [5])
    _write_year(tmp_path, 2024, [6])
    out = str(tmp_path / "out")
    jobs.backfill(spark, src, out, 2023, 2024)
    clean, _ = jobs.rolling_refresh(spark, src, out, dt.datetime(2024, 3, 1), years=1)
    years = sorted(r.year for r in read_station_days(spark, clean).select("year").distinct().collect())
    assert years == [2023, 2024]
    assert jobs.refresh_window(dt.date(2026, 1, 2)) == [2025, 2026]
    m = {r.metric: r.rows for r in jobs.run_metrics(spark, *jobs._outputs(out)).collect()}
    assert m == {"station_days": 2, "rejected": 0}


def test_atomic_replace_swaps_only_when_valid(spark, tmp_path):
    st1 = spark.createDataFrame([("CA1", 1.0, 2.0, 3.0, "ON", "A", None, None, None)], RAW_STATIONS_SCHEMA)
    st2 = spark.createDataFrame([("CA1", 1.0, 2.0, 3.0, "ON", "A", None, None, None),
                                 ("CA2", 1.0, 2.0, 3.0, "ON", "B", None, None, None)], RAW_STATIONS_SCHEMA)
    sinks.atomic_replace(spark, st1, str(tmp_path), "t_stations", RAW_STATIONS_SCHEMA, expected_rows=1)
    with pytest.raises(ValueError):
        sinks.atomic_replace(spark, st2, str(tmp_path), "t_stations", RAW_STATIONS_SCHEMA, expected_rows=5)
    assert spark.table("t_stations").count() == 1  # previous version still serving
    sinks.atomic_replace(spark, st2, str(tmp_path), "t_stations", RAW_STATIONS_SCHEMA, expected_rows=2)
    assert spark.table("t_stations").count() == 2


def test_table_name():
    assert sinks.table_name(None, "dev", "analytics") == "analytics"
    assert sinks.table_name("marts", "prod", "analytics") == "marts"
    assert sinks.table_name(" marts ", "dev", "analytics") == "analytics_marts"


def test_bucketed_fact_needs_no_station_exchange(spark, tmp_path):
    fct = spark.createDataFrame(
        [(f"CA{i % 7}", dt.date(2020 + i % 3, 1, 1 + i % 28), float(i)) for i in range(200)],
        "station_id string, observation_date date, tmax_c double")
    sinks.write_bucketed_fact(fct, "fct_b", 4, path=str(tmp_path / "fct_b"))
    stations = spark.table("fct_b").groupBy("station_id").count()
    assert "hashpartitioning(station_id" not in plan_text(stations)
    assert stations.count() == 7


def test_materialize(spark, tmp_path):
    df = spark.range(3)
    assert sinks.materialize(spark, df, "v_x", "view").count() == 3
    assert sinks.materialize(spark, df, "t_x", "table", str(tmp_path / "t")).count() == 3


def test_stream_ingest_two_landings(spark, tmp_path):
    from wxstar.streaming import start_incremental_ingest

    landing = tmp_path / "landing"
    landing.mkdir()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    for year, months in ((2023, [1, 2]), (2024, [3])):
        with gzip.open(landing / f"{year}.csv.gz", "wt") as f:
            for r in _year_rows(year, months):
                f.write(",".join("" if v is None else v for v in r) + "\n")
        start_incremental_ingest(spark, str(landing), out, checkpoint=ckpt).awaitTermination()
    sd = read_station_days(spark, f"{out}/processed/observations.parquet")
    assert sorted((r.year, r.month) for r in sd.collect()) == [(2023, "01"), (2023, "02"), (2024, "03")]


def test_star_schema_build(spark, tmp_path):
    src = _write_year(tmp_path, 2024, [1, 2])
    st_txt = tmp_path / "stations.txt"
    st_txt.write_text("CA000000001  45.0000  -75.0000  100.0 ON STATION ONE\n")
    clean, _ = jobs.ingest_year(spark, src, str(tmp_path / "o"), 2024)
    jobs.build_stations(spark, str(st_txt), str(tmp_path / "st"))
    built = jobs.build_star_schema(spark, clean, str(tmp_path / "st"), str(tmp_path / "wh"))
    assert built["mart_yearly_climate"].first().station_days == 2
    assert all(r.failures == 0 for r in built["data_tests"].collect())
    assert isinstance(models.OBSERVATION_RENAMES, dict)


def test_conform_orders_casts_and_rejects_missing(spark):
    df = spark.createDataFrame([("1.5", "CA1", "x")], "latitude string, id string, extra string")
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([StructField("id", StringType()), StructField("latitude", DoubleType())])
    out = sinks.conform(df, schema)
    assert out.columns == ["id", "latitude"] and out.first().latitude == 1.5
    with pytest.raises(ValueError, match="missing"):
        sinks.conform(df.drop("id"), schema)


def test_csv_duplicates_take_first_row_in_file(spark, tmp_path):
    src = tmp_path / "dup"
    src.mkdir()
    with gzip.open(src / "2024.csv.gz", "wt") as f:
        f.write("CA000000002,20240201,PRCP,30,,,S,\n")
        f.write("CA000000002,20240201,PRCP,10,,,S,\n")
        f.write("CA000000002,20240202,PRCP,5,,,S,\n")
        f.write("CA000000002,20240202,PRCP,70,,,S,\n")
    clean, _ = jobs.ingest_year(spark, str(src), str(tmp_path / "o"), 2024)
    got = {r.date.day: r.prcp for r in read_station_days(spark, clean).collect()}
    assert got == {1: 3.0, 2: 0.5}


def test_mart_on_bucketed_fact_has_one_exchange(spark, tmp_path):
    fct = spark.createDataFrame(
        [(f"CA{i % 7}", dt.date(2020 + i % 3, 1, 1 + i % 28), float(i), 0.0, 0.0, 0.0, 0, 0) for i in range(200)],
        "station_id string, observation_date date, tmax_c double, tmin_c double, tavg_c double, prcp_mm double, "
        "snow_fall_mm int, snwd_depth_mm int")
    sinks.write_bucketed_fact(fct, "fct_b2", 4, path=str(tmp_path / "fct_b2"))
    bucketed = models.mart_yearly_climate(spark.table("fct_b2"))
    plain = models.mart_yearly_climate(spark.read.parquet(str(tmp_path / "fct_b2")))
    assert plan_text(bucketed).count("hashpartitioning(") == 1   # only the year step
    assert plan_text(plain).count("hashpartitioning(") == 2
    assert sorted(map(tuple, bucketed.collect())) == sorted(map(tuple, plain.collect()))


def test_cli_jobs(spark, tmp_path):
    from wxstar.plans import cli

    src = _write_year(tmp_path, 2024, [1, 2])
    out = cli.main(["ingest-year", "--year", "2024", "--source-prefix", src, "--output-prefix", str(tmp_path / "o"),
                    "--JOB_NAME", "x"])
    assert read_station_days(spark, out["clean"]).count() == 2
    st_txt = tmp_path / "stations.txt"
    st_txt.write_text("CA000000001  45.0000  -75.0000  100.0 ON STATION ONE\n")
    cli.main(["stations", "--source-path", str(st_txt), "--output-path", str(tmp_path / "st")])
    cli.main(["star", "--observations", out["clean"], "--stations", str(tmp_path / "st"),
              "--warehouse", str(tmp_path / "wh")])
    out2 = cli.main(["refresh", "--source-prefix", src, "--output-prefix", str(tmp_path / "o"),
                     "--as-of", "2024-06-01", "--years", "1"])
    assert read_station_days(spark, out2["clean"]).count() == 2


def test_stream_replay_is_idempotent(spark, tmp_path):
    from wxstar.operators.validation import rerun_diff
    from wxstar.streaming import start_incremental_ingest

    landing = tmp_path / "landing"
    landing.mkdir()
    for year, months in ((2023, [1, 2]), (2024, [3, 4])):
        with gzip.open(landing / f"{year}.csv.gz", "wt") as f:
            for r in _year_rows(year, months):
                f.write(",".join("" if v is None else v for v in r) + "\n")
    out = str(tmp_path / "out")
    start_incremental_ingest(spark, str(landing), out, checkpoint=str(tmp_path / "c1")).awaitTermination()
    snap = read_station_days(spark, f"{out}/processed/observations.parquet")
    first = spark.createDataFrame(snap.collect(), snap.schema)  # snapshot before the replay
    # a lost checkpoint replays every file: the year replace makes the result identical
    start_incremental_ingest(spark, str(landing), out, checkpoint=str(tmp_path / "c2")).awaitTermination()
    second = read_station_days(spark, f"{out}/processed/observations.parquet")
    assert second.count() == 4
    assert rerun_diff(first, second).count() == 0


def test_ingest_survives_a_failed_task(spark, tmp_path):
    """The first attempt of one scan task fails (as on a lost executor); Spark retries it
    and the written result, including first-in-file duplicate resolution, is unchanged."""
    from pyspark import TaskContext
    from pyspark.sql import functions as F

    from wxstar.sources.files import read_observations, year_paths

    src = tmp_path / "src"
    src.mkdir()
    for year in (2023, 2024):
        with gzip.open(src / f"{year}.csv.gz", "wt") as f:
            for i in range(200):
                f.write(f"CA{i % 9:09d},{year}{1 + i % 12:02d}{1 + i % 27:02d},TMAX,{i},,,S,\n")
                f.write(f"CA{i % 9:09d},{year}{1 + i % 12:02d}{1 + i % 27:02d},TMAX,{i + 1000},,,S,\n")

    marker = str(tmp_path / "failed-once")

    @F.udf("boolean")
    def fail_first_attempt(_):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() == 0:
            open(marker, "w").close()
            raise RuntimeError("injected task failure")
        return True

    def run(out, inject):
        raw = read_observations(spark, year_paths(str(src), [2023, 2024]), with_position=True)
        if inject:
            raw = raw.filter(fail_first_attempt(F.col("id")))
        clean, _ = jobs.ingest(raw, str(out), years=[2023, 2024])
        return read_station_days(spark, clean)

    ok = run(tmp_path / "ok", inject=False)
    retried = run(tmp_path / "retried", inject=True)
    from wxstar.operators.validation import rerun_diff

    import os

    assert os.path.exists(marker)  # the failure really happened and was retried
    assert ok.count() > 0 and rerun_diff(ok, retried).count() == 0
    assert ok.agg(F.max("tmax")).first()[0] < 100  # the first row of each duplicate pair won


def test_undatable_rows_keep_their_file_year_in_quarantine(spark, tmp_path):
    from wxstar.sources.files import read_quarantine

    src = tmp_path / "src"
    src.mkdir()
    with gzip.open(src / "2024.csv.gz", "wt") as f:
        f.write("CA000000001,20240105,TMAX,10,,,S,\n")
        f.write("CA000000001,xxxx0101,TMAX,10,,,S,\n")  # no usable year in the date text
    for _ in range(2):  # a rerun replaces, it does not duplicate
        _, quarantine = jobs.ingest_year(spark, str(src), str(tmp_path / "o"), 2024)
    q = read_quarantine(spark, quarantine).collect()
    assert [(r.year, r.reason) for r in q] == [(2024, "bad_date")]


def test_rows_without_any_year_are_kept_apart(spark, tmp_path):
    raw = obs_rows(spark, [("CA000000001", "20240105", "TMAX", "10", None, None, "S", None),
                           ("CA000000001", "xxxx0101", "TMAX", "10", None, None, "S", None)])
    for _ in range(2):
        jobs.ingest(raw, str(tmp_path / "o"), years=[2024])
    undated = spark.read.parquet(jobs.undated_path(str(tmp_path / "o"))).collect()
    assert [(str(r.years), r.reason) for r in undated] == [("2024", "bad_date")]  # once, despite the rerun


def test_star_schema_with_bucketed_fact(spark, tmp_path):
    src = _write_year(tmp_path, 2024, [1, 2, 3])
    st_txt = tmp_path / "stations.txt"
    st_txt.write_text("CA000000001  45.0000  -75.0000  100.0 ON STATION ONE\n")
    clean, _ = jobs.ingest_year(spark, src, str(tmp_path / "o"), 2024)
    jobs.build_stations(spark, str(st_txt), str(tmp_path / "st"))
    built = jobs.build_star_schema(spark, clean, str(tmp_path / "st"), str(tmp_path / "wh"), buckets=4)
    assert built["mart_yearly_climate"].first().station_days == 3
    assert plan_text(models.mart_yearly_climate(built["fct_daily_weather"])).count("hashpartitioning(") == 1
    assert all(r.failures == 0 for r in built["data_tests"].collect())


def _land(folder, name, dates, station="CA000000001"):
    import gzip

    folder.mkdir(exist_ok=True)
    with gzip.open(folder / name, "wt") as f:
        for d in dates:
            f.write(f"{station},{d},TMAX,100,,,S,\n")


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_backfill_of_a_range_leaves_other_years(spark, tmp_path, mode):
    src, out = tmp_path / "src", str(tmp_path / "out")
    for y in (2021, 2022, 2023):
        _land(src, f"{y}.csv.gz", [f"{y}0105", f"{y}0205"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        jobs.backfill(spark, str(src), out, 2021, 2023)
        _land(src, "2022.csv.gz", ["20220105"])  # February goes
        clean, _ = jobs.backfill(spark, str(src), out, 2022, 2023)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    got = sorted((r.year, r.month) for r in read_station_days(spark, clean).select("year", "month").collect())
    assert got == [(2021, "01"), (2021, "02"), (2022, "01"), (2023, "01"), (2023, "02")]


def test_every_row_of_the_scope_is_accounted_for(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    _land(src, "2024.csv.gz", ["20240105", "20230105", "20250105", "20230230", "junk"])
    clean, quarantine = jobs.ingest_year(spark, str(src), out, 2024)
    reasons = sorted((r.year, r.reason) for r in spark.read.parquet(quarantine).collect())
    assert reasons == [(2024, "bad_date"), (2024, "bad_date"), (2024, "out_of_window"), (2024, "out_of_window")]
    assert read_station_days(spark, clean).count() == 1
    assert spark.read.schema("id string").parquet(jobs.undated_path(out)).count() == 0


def test_stream_keeps_a_year_that_is_split_over_micro_batches(spark, tmp_path):
    from wxstar.streaming.incremental import start_incremental_ingest

    src, out = tmp_path / "landing", str(tmp_path / "out")
    _land(src, "2024_a.csv.gz", ["20240105", "20240106"])
    _land(src, "2024_b.csv.gz", ["20240205"])
    _land(src, "2025.csv.gz", ["20250105", "20240230"])  # a stray text must not wipe 2024
    start_incremental_ingest(spark, str(src), out, checkpoint=str(tmp_path / "ck"), max_files_per_trigger=1).awaitTermination()
    got = sorted(str(r.date) for r in read_station_days(spark, f"{out}/processed/observations.parquet").collect())
    assert got == ["2024-01-05", "2024-01-06", "2024-02-05", "2025-01-05"]
    bad = spark.read.parquet(f"{out}/quarantined/observations.parquet").collect()
    assert [(r.year, r.reason) for r in bad] == [(2025, "bad_date")]


def test_replace_is_one_write_job_for_any_number_of_years(spark, tmp_path):
    rows = obs_rows(spark, [r for y in range(2000, 2012) for r in _year_rows(y, [1])])
    prepared = jobs.split_by_quality(jobs.prepare_observations(rows))[0]
    sc = spark.sparkContext
    sc.setJobGroup("replace-years", "count jobs")
    try:
        sinks.replace_years(prepared, str(tmp_path / "q"), range(2000, 2012))
    finally:
        sc.setJobGroup("other", "other")
    assert len(sc.statusTracker().getJobIdsForGroup("replace-years")) <= 3
    assert spark.read.parquet(str(tmp_path / "q")).select("year").distinct().count() == 12


@pytest.mark.parametrize("open_cost", ["1", "4194304"])
def test_repeated_cells_take_the_first_file_however_splits_are_packed(spark, tmp_path, open_cost):
    landing = tmp_path / "many files"  # names that need encoding in a path
    landing.mkdir()
    for i in range(12):
        rows = [f"CA{k:09d},20240101,TMAX,{100 * i + k},,,E,\n" for k in range(i, 30)]
        with gzip.open(landing / f"f{i:02d}.csv.gz", "wt") as f:
            f.writelines(rows)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
    try:
        raw = read_observations(spark, str(landing), with_position=True)
        clean, _ = jobs.ingest(raw, str(tmp_path / "out"))
        got = {r.id: r.tmax for r in read_station_days(spark, clean).collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert got == {f"CA{k:09d}": k / 10 for k in range(30)}


def test_tables_loaded_together_switch_together(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StructField, StructType

    schema = StructType([StructField("k", IntegerType())])
    rows = lambda n: spark.range(n).select(F.col("id").cast("int").alias("k"))
    root = str(tmp_path / "raw")
    sinks.load_together(spark, {"a": (rows(3), schema, 3), "b": (rows(4), schema, 4)}, root)
    with pytest.raises(ValueError):
        sinks.load_together(spark, {"a": (rows(5), schema, 5), "b": (rows(6), schema, 7)}, root)
    counts = lambda: [sinks.read_loaded(spark, root, n, schema).count() for n in "ab"]
    assert counts() == [3, 4]
    sinks.load_together(spark, {"a": (rows(5), schema, 5), "b": (rows(6), schema, 6)}, root)
    assert counts() == [5, 6]


def test_metrics_of_a_run_count_its_years_alone(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for y in (2023, 2024):
        with gzip.open(src / f"{y}.csv.gz", "wt") as f:
            f.write(f"CA000000001,{y}0101,TMAX,1,,,E,\nCA000000001,{y}0230,TMAX,1,,,E,\n"
                    f"CA000000001,{y}0102,TMAX,1,,X,E,\nCA000000001,20220102,TMAX,1,,,E,\n")
    jobs.backfill(spark, str(src), str(tmp_path / "out"), 2023, 2024)
    paths = jobs.ingest_year(spark, str(src), str(tmp_path / "out"), 2024)
    got = {r.metric: r.rows for r in jobs.run_metrics(spark, *paths, [2024]).collect()}
    assert got == {"station_days": 1, "rejected_bad_date": 1, "rejected_q_flag": 1, "rejected_out_of_window": 1, "undated": 0}
