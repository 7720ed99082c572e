"""Catalog tables switched by location: crash safety, other sessions, metrics of the write, marts by changed years."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import obs_rows, plan_text
from wxstar.operators import models, profiling, validation
from wxstar.plans import lake
from wxstar.schemas import QUARANTINE_SCHEMA, RAW_STATIONS_SCHEMA
from wxstar.sinks import catalog
from wxstar import sinks


@pytest.fixture
def namespace():
    return f"ns_{uuid.uuid4().hex[:8]}"


def rows_of(spark, years, value="10", months=(1, 6)):
    return obs_rows(spark, [(f"CA{s}", f"{y}{m:02d}05", "TMAX", value) for y in years for m in months for s in range(3)])


def yearly(spark, table):
    """year -> (rows, values) as a new session reads it."""
    got = spark.newSession().table(table).groupBy("year").agg(F.count("*").alias("n"), F.collect_set("tmax").alias("v")).collect()
    return {r.year: (r.n, set(r.v)) for r in got}


def test_kill_between_any_two_steps_leaves_every_year_whole(spark, tmp_path, namespace, monkeypatch):
    """The rerun dies at its k-th step, for every k: each year then reads as before or as rerun, and a rerun ends it."""
    years, table = [2020, 2021, 2022], f"{namespace}.station_days"
    lake.ingest_years(rows_of(spark, years), namespace, str(tmp_path), years)
    old, new = (6, {1.0}), (3, {2.0})
    rerun = rows_of(spark, [2021, 2022], "20", months=(6,))
    steps = {"n": 0, "fail_at": None}

    def counted(step):
        def run(*args, **kwargs):
            steps["n"] += 1
            if steps["n"] == steps["fail_at"]:
                raise KeyboardInterrupt
            return step(*args, **kwargs)
        return run

    monkeypatch.setattr(catalog, "write_partitions", counted(catalog.write_partitions))
    monkeypatch.setattr(catalog, "switch", counted(catalog.switch))
    for k in range(1, 12):
        lake.ingest_years(rows_of(spark, [2021, 2022]), namespace, str(tmp_path), [2021, 2022])  # back to the old rows
        assert yearly(spark, table) == dict.fromkeys(years, old)
        steps.update(n=0, fail_at=k)
        try:
            lake.ingest_years(rerun, namespace, str(tmp_path), [2021, 2022])
            steps["fail_at"] = None
            break
        except KeyboardInterrupt:
            steps["fail_at"] = None
        got = yearly(spark, table)
        assert got[2020] == old and all(got[y] in (old, new) for y in (2021, 2022)), (k, got)
    assert k == 11  # four writes and six switches were interrupted in turn
    assert yearly(spark, table) == {2020: old, 2021: new, 2022: new}


def test_years_without_rows_and_clean_up(spark, tmp_path, namespace):
    table = f"{namespace}.station_days"
    lake.ingest_years(rows_of(spark, [2020, 2021]), namespace, str(tmp_path), [2020, 2021])
    lake.ingest_years(rows_of(spark, [2020]).limit(0), namespace, str(tmp_path), [2021])
    assert yearly(spark, table) == {2020: (6, {1.0})}
    names = [f"{namespace}.{t}" for t in ("station_days", "quarantine")]
    lake.ingest_years(rows_of(spark, [2020], "30"), namespace, str(tmp_path), [2020])
    assert len(catalog.drop_unused_versions(spark, str(tmp_path), names)) == 1  # the first run's
    assert yearly(spark, table) == {2020: (6, {3.0})}


def test_metrics_are_observed_in_the_write_jobs(spark, tmp_path, namespace):
    raw = obs_rows(spark, [
        ("CA1", "20200105", "TMAX", "1"), ("CA1", "20200105", "TMIN", "1"), ("CA2", "20200230", "TMAX", "1"), ("CA2", "20200106", "TMAX", "1", "", "X"),
        ("CA2", "20191231", "TMAX", "1"), ("CA2", "", "TMAX", "1")])
    run = lake.ingest_years(raw, namespace, str(tmp_path), [2020])
    got = {r.metric: r.rows for r in spark.table(f"{namespace}.run_metrics").filter(F.col("run") == run).collect()}
    assert got == {"station_days": 1, "rejected_q_flag": 1, "rejected_bad_date": 1, "undated": 2}
    # the good row of another year and the row without a date have no year of the run
    assert spark.table(f"{namespace}.undated").count() == 2
    reread = spark.table(f"{namespace}.quarantine").groupBy("reason").count().collect()
    assert {f"rejected_{r.reason}": r["count"] for r in reread}.items() <= got.items()
    group = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lake", "metrics")
    try:
        spark.table(f"{namespace}.run_metrics").collect()
        assert len(group.getJobIdsForGroup("lake")) == 1  # metrics come from their own table alone
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_mart_refresh_touches_only_its_years(spark, tmp_path, namespace):
    years = range(2015, 2022)
    lake.ingest_years(rows_of(spark, years), namespace, str(tmp_path), years)
    lake.refresh_mart(spark, namespace, str(tmp_path), years)
    table = f"{namespace}.mart_yearly_climate"
    files = lambda: {f for f in spark.newSession().table(table).inputFiles()}
    before = files()
    lake.ingest_years(rows_of(spark, [2020, 2021], "50"), namespace, str(tmp_path), [2020, 2021])
    lake.refresh_mart(spark, namespace, str(tmp_path), [2020, 2021])
    assert len(before & files()) == 5 and len(files()) == 7
    days = spark.table(f"{namespace}.station_days")
    full = models.mart_yearly_climate(models.fct_daily_weather(models.stg_observations(days)))
    assert validation.rerun_diff(full, spark.table(table).select(*full.columns)).isEmpty()


def test_a_year_filter_opens_that_year_alone(spark, tmp_path, namespace):
    lake.ingest_years(rows_of(spark, [2020, 2021]), namespace, str(tmp_path), [2020, 2021])
    one = spark.table(f"{namespace}.station_days").filter("year = 2021 AND month = '06'")
    assert all("year=2021" in f for f in one.inputFiles())
    text = plan_text(one)
    assert "PartitionFilters: [isnotnull(year" in text and "EqualTo(month,06)" in text
    assert one.count() == 3


def test_marts_are_switched_not_overwritten(spark, tmp_path):
    name = f"mart_{uuid.uuid4().hex[:8]}"
    first = sinks.materialize(spark, spark.range(3), name, "table", str(tmp_path))
    old_files = first.inputFiles()
    with pytest.raises(ValueError):
        catalog.publish_table(spark, spark.range(9), name, str(tmp_path), expected_rows=8)
    assert spark.newSession().table(name).count() == 3
    sinks.materialize(spark, spark.range(5), name, "table", str(tmp_path))
    assert spark.newSession().table(name).count() == 5
    assert spark.read.parquet(*old_files).count() == 3  # a reader of the old version is not cut off


def test_view_is_repointed_for_open_sessions(spark, tmp_path):
    row = ("CA1", 1.0, 2.0, 3.0, "ON", "A", None, None, None)
    name, other = f"v_{uuid.uuid4().hex[:8]}", spark.newSession()
    for n in (1, 2):
        sinks.atomic_replace(spark, spark.createDataFrame([row] * n, RAW_STATIONS_SCHEMA), str(tmp_path), name, RAW_STATIONS_SCHEMA, n)
        assert other.table(name).count() == n
    sinks.atomic_replace(spark, spark.createDataFrame([], RAW_STATIONS_SCHEMA), str(tmp_path), name, RAW_STATIONS_SCHEMA, 0)
    assert other.table(name).count() == 0 and other.table(name).columns == RAW_STATIONS_SCHEMA.fieldNames()


def test_co_bucketed_star_join_has_no_station_exchange(spark, tmp_path):
    fct = spark.createDataFrame(
        [(f"CA{i % 17}", dt.date(2020, 1 + i % 12, 1 + i % 28), float(i), 1.0) for i in range(400)],
        "station_id string, observation_date date, tmax_c double, prcp_mm double")
    dim = spark.createDataFrame([(f"CA{i}", "ON" if i % 2 else "BC") for i in range(17)], "station_id string, province string")
    names = [f"{n}_{uuid.uuid4().hex[:8]}" for n in ("fct", "dim")]
    sinks.write_bucketed_fact(fct, names[0], 4, str(tmp_path / "f"))
    sinks.write_bucketed(dim, names[1], "station_id", 4, path=str(tmp_path / "d"))
    tables = [spark.table(n) for n in names]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = models.star_climate_by_province_season(*tables, models.dim_date(fct))
        text = plan_text(joined)
        assert "SortMergeJoin" in text and "hashpartitioning(station_id" not in text
        plain = models.star_climate_by_province_season(fct, dim, models.dim_date(fct))
        assert "hashpartitioning(station_id" in plan_text(plain)
        assert validation.rerun_diff(joined, plain).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucket_count_follows_the_size(spark):
    small = spark.range(10)
    assert sinks.bucket_count(small) == 1
    assert sinks.bucket_count(spark.range(10**9), bucket_bytes=1 << 20) == 4096
    assert sinks.bucket_count(spark.range(1 << 20), bucket_bytes=1 << 20) == 8


def test_suite_scans_each_table_once_in_one_exchange(spark):
    cols = {
        "raw_stations": "id string", "raw_observations": "id string, date date",
        "dim_date": "date_day date, year int, month int, day int, season string",
        "dim_station": "station_id string, latitude double, longitude double, elevation_m double, station_name string",
        "fct": "station_id string, observation_date date, tmax_c double, tmin_c double",
        "mart": "observation_year int, station_count bigint, tmax_days bigint, station_days bigint"}
    dfs = {n: spark.createDataFrame([], ddl) for n, ddl in cols.items()}
    made = validation.run_data_tests(*(dfs[n] for n in ("raw_stations", "raw_observations", "dim_date", "dim_station", "fct", "mart")))
    assert made._jdf.queryExecution().sparkPlan().toString().count("Scan ExistingRDD") == 6
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2  # by (set, key), and the total
    assert {r.failures for r in made.collect()} == {0} and made.count() == 26


def test_grain_by_bitmaps_and_by_sets(spark, monkeypatch):
    rows = [("CA1", "20200101", e) for e in ("TMAX", "TMAX", "TMIN", None, None)] + [("CA1", None, "TMAX"), (None, "20200101", "WT01"), ("US1", "20200101", "TMAX")]
    rows += [("CA9", "20200101", f"E{i}") for i in range(200)]  # several words
    obs = spark.createDataFrame(rows, "id string, date string, element string")
    made = profiling.grain_check(obs)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2  # station-days, and the total
    want = {"whole": (208, 206, 2, 5), "pipeline": (4, 3, 1, 2)}
    assert {r[0]: tuple(r[1:]) for r in made.collect()} == want
    monkeypatch.setattr(profiling, "ELEMENT_WORDS", 1)
    assert {r[0]: tuple(r[1:]) for r in profiling.grain_check(obs).collect()} == want
    assert [tuple(r[1:]) for r in profiling.grain_check(obs.limit(0)).collect()] == [(0, 0, 0, 0)] * 2


def test_equal_partitions_are_not_compared_row_by_row(spark, tmp_path):
    days = spark.createDataFrame(
        [(f"CA{i % 5}", dt.date(2020 + i % 3, 1 + i % 4, 1), float(i)) for i in range(300)], "id string, date date, tmax double").withColumns(
        {"year": F.year("date"), "month": F.date_format("date", "MM")})
    twice = days.unionByName(days.filter("year = 2020 AND month = '01'").limit(1))  # a repeated row counts
    changed = twice.withColumn("tmax", F.when((F.col("year") == 2021) & (F.col("tmax") == 7.0), 8.0).otherwise(F.col("tmax")))
    old, new = (spark.read.parquet(str(tmp_path / n)) for n, df in (("a", days), ("b", changed))
                if df.write.partitionBy("year", "month").parquet(str(tmp_path / n)) is None)
    parts = validation.differing_partitions(old, new, ["year", "month"])
    assert len(parts) == 2
    diff = validation.rerun_diff_by_partition(old, new, ["year", "month"])
    assert sorted(r.side for r in diff.collect()) == ["new_only", "new_only", "old_only"]
    assert validation.rerun_diff(diff, validation.rerun_diff(old, new).select(*diff.columns)).isEmpty()
    filters = re.findall(r"PartitionFilters: (.*)", plan_text(diff))
    assert len(filters) == 2 and all("year" in f and "month" in f for f in filters), filters  # the scans open these partitions alone
    assert validation.rerun_diff_by_partition(old, old, ["year", "month"]).isEmpty()


def test_quarantine_schema_is_kept(spark, tmp_path, namespace):
    lake.open_lake(spark, namespace, str(tmp_path))
    assert spark.table(f"{namespace}.quarantine").schema.fieldNames()[-1] == "year"
    assert set(spark.table(f"{namespace}.quarantine").columns) == set(QUARANTINE_SCHEMA.fieldNames())
