"""Registered queries that exercise the file sources, sinks and jobs end to end.

Each writes the tables-derived data under a fresh folder inside the session's shared
checkpoint location (``spark.checkpoint.dir``; a temporary folder only where it is unset,
as in local tests), runs the job, and returns what it reads back.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxstar.operators import models, profiling, trends, validation
from wxstar.plans import jobs
from wxstar.plans.star import star_from_tables
from wxstar.schemas import OBSERVATION_COLUMNS, RAW_OBSERVATIONS_SCHEMA, RAW_STATIONS_SCHEMA
from wxstar.session import scratch_dir
from wxstar.sinks import parquet as sinks
from wxstar.sources import tables
from wxstar.sources.files import read_observations, read_quarantine, read_station_days, read_yearly_extract

REPLACE_YEAR = 1998
DROPPED_MONTH = "02"
BACKFILL_UNTIL = 1999           # first backfill covers the years up to this one
AS_OF = _dt.date(2001, 6, 1)    # rolling refresh adds [2000, 2001]
BUCKETS = 8
FIRST_YEAR = 1995
LANDING_FILES = 8          # files of one landing at least, in source order
ROWS_PER_PART = 500_000    # rows of a part, which one task sorts and writes: their number grows with the rows, not a task's memory
ROUND = 4


def _raw(spark, sf_dir):
    return tables.long_observations(spark, sf_dir)


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows -> headerless gzip CSV, one folder per year -> one multi-year scan with the
    fixed schema -> coverage by year."""
    out = scratch_dir(spark, "csv")
    raw = _raw(spark, sf_dir).select(*OBSERVATION_COLUMNS)
    (
        raw.withColumn("file_year", F.substring("date", 1, 4).try_cast("int"))
        .write.partitionBy("file_year").option("compression", "gzip").csv(out)
    )
    back = read_observations(spark, out)
    return profiling.coverage_by_year(back, year_col="file_year")


def q_parquet_partition_roundtrip(spark, sf_dir):
    """Station-days -> ``year=/month=`` Parquet -> read back with the explicit schema."""
    root = scratch_dir(spark, "parquet")
    path = sinks.write_station_days(star_from_tables(spark, sf_dir).station_days, root)
    return read_station_days(spark, path)


def q_partition_pruned_months(spark, sf_dir):
    """Monthly counts of one year from the partitioned files (the year filter prunes)."""
    root = scratch_dir(spark, "pruned")
    path = sinks.write_station_days(star_from_tables(spark, sf_dir).station_days, root)
    return trends.monthly_counts(read_station_days(spark, path), REPLACE_YEAR)


def q_quarantine_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "quarantine")
    path = sinks.write_quarantine(star_from_tables(spark, sf_dir).rejected, root)
    back = read_quarantine(spark, path)
    return back.groupBy("year", "reason").agg(F.count("*").alias("rows"))


def q_year_replace(spark, sf_dir):
    """Write all years, then re-run one year whose February is gone: the month must
    vanish (a dynamic overwrite would leave it stale)."""
    root = scratch_dir(spark, "replace")
    sd = star_from_tables(spark, sf_dir).station_days
    path = sinks.write_station_days(sd, root)
    rerun = sd.filter(~((F.col("year") == REPLACE_YEAR) & (F.col("month") == DROPPED_MONTH)))
    sinks.replace_years(rerun, path, [REPLACE_YEAR])
    return read_station_days(spark, path).groupBy("year", "month").agg(F.count("*").alias("rows"))


def q_atomic_replace(spark, sf_dir):
    """All stations, then those with a WMO id, then a load whose count is wrong: the second
    load must be serving, in any session."""
    root = scratch_dir(spark, "atomic")
    stations = star_from_tables(spark, sf_dir).stations
    with_wmo = stations.filter(F.col("wmo_id").isNotNull())
    name = f"raw_stations_{uuid.uuid4().hex[:8]}"
    sinks.atomic_replace(spark, stations, root, name, schema=RAW_STATIONS_SCHEMA)
    sinks.atomic_replace(spark, with_wmo, root, name, schema=RAW_STATIONS_SCHEMA)
    try:
        sinks.atomic_replace(spark, stations, root, name, schema=RAW_STATIONS_SCHEMA, expected_rows=-1)
    except ValueError:
        return spark.newSession().table(name)
    raise AssertionError("a load with a wrong count was switched")


def q_load_together(spark, sf_dir):
    """Both raw tables loaded, then again with the first year cut off, then a load whose
    second table fails its count: both tables keep the second load."""
    root = f"{scratch_dir(spark, 'together')}/{sinks.table_name('raw')}"
    s = star_from_tables(spark, sf_dir)
    later = s.raw_obs_table.filter(F.year("date") > FIRST_YEAR)

    def load(obs, expected=None):
        return sinks.load_together(spark, {"raw_observations": (obs, RAW_OBSERVATIONS_SCHEMA, None),
                                           "raw_stations": (s.stations, RAW_STATIONS_SCHEMA, expected)}, root)

    load(s.raw_obs_table)
    load(later)
    try:
        load(s.raw_obs_table, expected=-1)
    except ValueError:
        obs = sinks.read_loaded(spark, root, "raw_observations", RAW_OBSERVATIONS_SCHEMA)
        stations = sinks.read_loaded(spark, root, "raw_stations", RAW_STATIONS_SCHEMA)
        per_year = obs.groupBy(F.year("date").alias("year")).agg(F.count("*").alias("rows"))
        return per_year.withColumn("model", F.lit("raw_observations")).unionByName(
            stations.agg(F.count("*").alias("rows")).withColumns(
                {"year": F.lit(None).cast("int"), "model": F.lit("raw_stations")})
        ).withColumn("namespace", F.lit(root.rsplit("/", 1)[1]))
    raise AssertionError("a load with a wrong count was switched")


def q_bucketed_fact(spark, sf_dir):
    """Yearly mart over the fact stored bucketed by station and sorted by date."""
    root = scratch_dir(spark, "bucketed")
    name = f"fct_bucketed_{uuid.uuid4().hex[:8]}"
    sinks.write_bucketed_fact(star_from_tables(spark, sf_dir).fct, name, BUCKETS, path=root)
    m = models.with_tmax_share(models.mart_yearly_climate(spark.table(name), exact_digits=ROUND))
    avgs = ["avg_tmax_c", "avg_tmin_c", "avg_tavg_c", "avg_prcp_mm", "avg_snow_mm", "avg_snwd_mm"]
    return m.select("observation_year", "station_count", "tmax_days", "station_days", "tmax_share", *avgs)


def q_ingest_year(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    clean, _ = jobs.ingest(_raw(spark, sf_dir), root, years=[REPLACE_YEAR], order_key="src_order")
    return read_station_days(spark, clean)


def q_backfill_years(spark, sf_dir):
    root = scratch_dir(spark, "backfill")
    clean, _ = jobs.ingest(_raw(spark, sf_dir), root, order_key="src_order")
    return trends.yearly_counts(read_station_days(spark, clean))


def q_rolling_window(spark, sf_dir):
    """Backfill up to 1999, then the rolling two-year refresh as of mid-2001 adds 2000
    and 2001 without touching earlier years."""
    root = scratch_dir(spark, "rolling")
    raw = _raw(spark, sf_dir)
    year_text = F.substring("date", 1, 4).try_cast("int")
    jobs.ingest(raw.filter(year_text <= BACKFILL_UNTIL), root, order_key="src_order")
    window = jobs.refresh_window(AS_OF)
    clean, _ = jobs.ingest(raw.filter(year_text.isin(window)), root, years=window, order_key="src_order")
    return read_station_days(spark, clean).groupBy("year", "month").agg(F.count("*").alias("rows"))


def q_run_metrics(spark, sf_dir):
    root = scratch_dir(spark, "metrics")
    clean, quarantine = jobs.ingest(_raw(spark, sf_dir), root, order_key="src_order")
    return jobs.run_metrics(spark, clean, quarantine)


def _parts(rows: int) -> int:
    return max(LANDING_FILES, -(-rows // ROWS_PER_PART))


def _yearly_files(spark, raw: DataFrame, parts: int | None = None) -> str:
    """``raw`` as a source of yearly files, ``{prefix}/{year}-{part}.csv.gz`` (the layout that the jobs read): rows in source
    order over the parts, which are ranges of it of about ``ROWS_PER_PART`` rows, so no task writes a whole year."""
    parts = parts or _parts(raw.count())
    stage, prefix = scratch_dir(spark, "by-year-parts"), scratch_dir(spark, "by-year")
    (
        raw.withColumn("file_year", F.substring("date", 1, 4).cast("int"))
        .repartitionByRange(parts, "file_year", "src_order").sortWithinPartitions("file_year", "src_order")
        .select(*OBSERVATION_COLUMNS, "file_year")
        .write.partitionBy("file_year").option("compression", "gzip").csv(stage)
    )
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(stage).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(prefix))
    for part in fs.globStatus(path(f"{stage}/file_year=*/part-*")):  # at most one per part and calendar year
        year, number = part.getPath().getParent().getName().split("=")[1], part.getPath().getName().split("-")[1]
        if not fs.rename(part.getPath(), path(f"{prefix}/{year}-{number}.csv.gz")):
            raise OSError(f"could not place a part of {year}")
    return prefix


def q_file_year_coverage(spark, sf_dir):
    """One scan over all yearly files, the year taken from each file's name -> coverage by year."""
    raw = read_observations(spark, f"{_yearly_files(spark, _raw(spark, sf_dir))}/*.csv.gz", with_file_year=True)
    return profiling.coverage_by_year(raw, year_col="file_year")


def q_file_year_missing(spark, sf_dir):
    """The same scan where one file's name has no year: it fails, and tells the file; without the year all rows are there."""
    prefix = _yearly_files(spark, _raw(spark, sf_dir))
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(prefix).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.rename(fs.globStatus(path(f"{prefix}/*.csv.gz"))[0].getPath(), path(f"{prefix}/yearless.csv.gz"))
    try:
        read_observations(spark, prefix, with_file_year=True).agg(F.max("file_year")).collect()
    except PySparkException as e:
        told = re.search(r"cannot infer year from file name: [\w.]+", str(e)).group()
        return read_observations(spark, prefix).agg(F.count("*").alias("rows")).withColumn("error", F.lit(told))
    raise AssertionError("a file without a year was read")


def _without_month(raw: DataFrame) -> DataFrame:
    return raw.filter(~F.coalesce(F.col("date").startswith(f"{REPLACE_YEAR}{DROPPED_MONTH}"), F.lit(False)))


def q_job_ingest_year(spark, sf_dir):
    """The one-year job over yearly files."""
    clean, _ = jobs.ingest_year(spark, _yearly_files(spark, _raw(spark, sf_dir)), scratch_dir(spark, "job"), REPLACE_YEAR)
    return read_station_days(spark, clean)


def q_job_rolling_refresh(spark, sf_dir):
    """Backfill up to 1999 from yearly files, then the two-year refresh as of mid-2001."""
    src, root = _yearly_files(spark, _raw(spark, sf_dir)), scratch_dir(spark, "job")
    jobs.backfill(spark, src, root, FIRST_YEAR, BACKFILL_UNTIL)
    clean, _ = jobs.rolling_refresh(spark, src, root, AS_OF)
    return read_station_days(spark, clean)


def q_backfill_subrange(spark, sf_dir):
    """Backfill of all years, then of 1998-1999 from files where February 1998 is gone: the
    month goes, the other years stay."""
    raw, root = _raw(spark, sf_dir), scratch_dir(spark, "job")
    jobs.backfill(spark, _yearly_files(spark, raw), root, FIRST_YEAR, AS_OF.year)
    clean, _ = jobs.backfill(spark, _yearly_files(spark, _without_month(raw)), root, REPLACE_YEAR, BACKFILL_UNTIL)
    return read_station_days(spark, clean)


def q_ingest_accounting(spark, sf_dir):
    """One year's file with the December before planted in it: every row of the scope is a
    clean row of the year or in the quarantine, by reason."""
    raw, root = _raw(spark, sf_dir), scratch_dir(spark, "job")
    landing = scratch_dir(spark, "strays")
    in_file = F.col("date").startswith(str(REPLACE_YEAR)) | F.col("date").startswith(f"{REPLACE_YEAR - 1}12")
    raw.filter(in_file).select(*OBSERVATION_COLUMNS).write.csv(landing)
    src = read_observations(spark, landing, with_position=True).withColumn("source_year", F.lit(REPLACE_YEAR))
    clean, quarantine = jobs.ingest(src, root, years=[REPLACE_YEAR])
    return jobs.run_metrics(spark, clean, quarantine, [REPLACE_YEAR])


def q_run_metrics_of_run(spark, sf_dir):
    """Metrics of a one-year run over a lake that already holds all years."""
    src, root = _yearly_files(spark, _raw(spark, sf_dir)), scratch_dir(spark, "job")
    jobs.backfill(spark, src, root, FIRST_YEAR, AS_OF.year)
    return jobs.run_metrics(spark, *jobs.ingest_year(spark, src, root, REPLACE_YEAR), [REPLACE_YEAR])


def q_duplicate_cells_multi_file(spark, sf_dir):
    """Rows in source order over many files, so copies of a cell lie in different files and
    the first file's value counts: all station-days with their values."""
    landing, raw = scratch_dir(spark, "many"), _raw(spark, sf_dir)
    (
        raw.repartitionByRange(_parts(raw.count()), "src_order").sortWithinPartitions("src_order")
        .select(*OBSERVATION_COLUMNS).write.option("compression", "gzip").csv(landing)
    )
    clean, _ = jobs.ingest(read_observations(spark, landing, with_position=True), scratch_dir(spark, "job"))
    return read_station_days(spark, clean)


def _two_runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Station-days of two runs, written and read back: the second lacks February 1998 and
    reads TMAX one degree higher in January 1997."""
    sd = star_from_tables(spark, sf_dir).station_days
    month = lambda y, m: (F.col("year") == y) & (F.col("month") == m)
    changed = sd.filter(~month(REPLACE_YEAR, DROPPED_MONTH)).withColumn(
        "tmax", F.when(month(REPLACE_YEAR - 1, "01"), F.col("tmax") + 1).otherwise(F.col("tmax")))
    return tuple(read_station_days(spark, sinks.write_station_days(df, scratch_dir(spark, "rerun"))) for df in (sd, changed))


def q_rerun_diff(spark, sf_dir):
    old, new = _two_runs(spark, sf_dir)
    return validation.rerun_diff(old, new)


def q_rerun_diff_by_partition(spark, sf_dir):
    """The same two runs compared partition by partition."""
    old, new = _two_runs(spark, sf_dir)
    return validation.rerun_diff_by_partition(old, new, ["year", "month"])


def q_reconcile_extract(spark, sf_dir):
    """The mart against a published yearly extract (headed CSV) that counts one station too
    many in 1998."""
    mart = models.mart_yearly_climate(star_from_tables(spark, sf_dir).fct, exact_digits=ROUND)
    published = scratch_dir(spark, "extract")
    one_more = F.when(F.col("observation_year") == REPLACE_YEAR, 1).otherwise(0)
    mart.select("observation_year", (F.col("station_count") + one_more).alias("station_count"), "avg_tmax_c").write.csv(
        published, header=True)
    return validation.reconcile(mart, read_yearly_extract(spark, published), "observation_year",
                                ["station_count", "avg_tmax_c"], "mart", "extract")


def _stations_file(spark, sf_dir) -> str:
    path = scratch_dir(spark, "stations-txt")
    tables.station_lines(spark, sf_dir).write.text(path)
    return path


def q_stations_build(spark, sf_dir):
    out = scratch_dir(spark, "stations")
    return jobs.build_stations(spark, _stations_file(spark, sf_dir), out)


def _built_star(spark, sf_dir, target="dev"):
    root = scratch_dir(spark, "star")
    clean, _ = jobs.ingest(_raw(spark, sf_dir), root, order_key="src_order")
    stations = f"{root}/processed/stations.parquet"
    jobs.build_stations(spark, _stations_file(spark, sf_dir), stations)
    return jobs.build_star_schema(spark, clean, stations, f"{root}/warehouse", target)


def q_star_schema_counts(spark, sf_dir):
    built = _built_star(spark, sf_dir)
    return validation.row_counts({name: df for name, df in built.items() if name != "data_tests"})


def q_star_data_tests(spark, sf_dir):
    return _built_star(spark, sf_dir)["data_tests"]


def _streamed(spark, sf_dir) -> DataFrame:
    """Two landings of CSV files (up to 1999, then 2000-2001) consumed by the incremental
    stream; files keep the source order."""
    from wxstar.streaming.incremental import start_incremental_ingest

    landing = scratch_dir(spark, "landing")
    out = scratch_dir(spark, "stream-out")
    ckpt = scratch_dir(spark, "stream-ckpt")
    raw = _raw(spark, sf_dir)
    year_text = F.substring("date", 1, 4).try_cast("int")
    for part, cond in (("a", year_text <= BACKFILL_UNTIL), ("b", year_text > BACKFILL_UNTIL)):
        rows = raw.filter(cond)
        rows = rows.repartitionByRange(_parts(rows.count()), "src_order").sortWithinPartitions("src_order")
        rows.select(*OBSERVATION_COLUMNS).write.option("compression", "gzip").csv(f"{landing}/{part}")
        q = start_incremental_ingest(spark, f"{landing}/*", out, checkpoint=ckpt)
        q.awaitTermination()
    return read_station_days(spark, f"{out}/processed/observations.parquet")


def q_stream_ingest(spark, sf_dir):
    """Yearly station-day counts of the streamed lake."""
    sd = _streamed(spark, sf_dir)
    return sd.groupBy("year").agg(F.count("*").alias("station_days"), F.countDistinct("id").alias("stations"))


def q_stream_values(spark, sf_dir):
    """All station-days of the streamed lake, with their values."""
    return _streamed(spark, sf_dir)


QUERIES = {
    "csv_roundtrip": q_csv_roundtrip,
    "parquet_partition_roundtrip": q_parquet_partition_roundtrip,
    "partition_pruned_months": q_partition_pruned_months,
    "quarantine_roundtrip": q_quarantine_roundtrip,
    "year_replace": q_year_replace,
    "atomic_replace": q_atomic_replace,
    "bucketed_fact": q_bucketed_fact,
    "ingest_year": q_ingest_year,
    "backfill_years": q_backfill_years,
    "rolling_window": q_rolling_window,
    "run_metrics": q_run_metrics,
    "stations_build": q_stations_build,
    "star_schema_counts": q_star_schema_counts,
    "star_data_tests": q_star_data_tests,
    "stream_ingest": q_stream_ingest,
    "stream_values": q_stream_values,
    "load_together": q_load_together,
    "file_year_coverage": q_file_year_coverage,
    "file_year_missing": q_file_year_missing,
    "job_ingest_year": q_job_ingest_year,
    "job_rolling_refresh": q_job_rolling_refresh,
    "backfill_subrange": q_backfill_subrange,
    "ingest_accounting": q_ingest_accounting,
    "run_metrics_of_run": q_run_metrics_of_run,
    "duplicate_cells_multi_file": q_duplicate_cells_multi_file,
    "rerun_diff": q_rerun_diff,
    "rerun_diff_by_partition": q_rerun_diff_by_partition,
    "reconcile_extract": q_reconcile_extract,
}


def oracles(w) -> dict[str, str]:
    """Oracle SQL; ``w(chain, body)`` prefixes the adapter CTEs of ``__spark_entry__``."""
    o = {}
    o["csv_roundtrip"] = w("raw", """
, y AS (SELECT TRY_CAST(substr(date, 1, 4) AS INTEGER) AS file_year, * FROM raw)
SELECT file_year AS year, count(*) AS total_rows, count(*) FILTER (WHERE starts_with(id, 'CA')) AS ca_rows,
       count(DISTINCT id) FILTER (WHERE starts_with(id, 'CA')) AS ca_stations,
       count(DISTINCT id) FILTER (WHERE starts_with(id, 'CA') AND element = 'TMAX') AS tmax_stations,
       count(DISTINCT id) FILTER (WHERE starts_with(id, 'CA') AND element = 'PRCP') AS prcp_stations,
       count(DISTINCT id) FILTER (WHERE starts_with(id, 'CA') AND element = 'TAVG') AS tavg_stations,
       round(count(*) FILTER (WHERE starts_with(id, 'CA')) * 100.0 / count(*), 2) AS ca_pct
FROM y GROUP BY file_year""")
    o["file_year_coverage"] = o["csv_roundtrip"]
    o["file_year_missing"] = w(
        "raw", "SELECT count(*) AS rows, 'cannot infer year from file name: yearless.csv.gz' AS error FROM raw")
    o["parquet_partition_roundtrip"] = w("wide", "SELECT * FROM wide")
    o["partition_pruned_months"] = w(
        "wide", f"SELECT month, count(*) AS count FROM wide WHERE year = {REPLACE_YEAR} GROUP BY month")
    o["quarantine_roundtrip"] = w("rejected", "SELECT year, reason, count(*) AS rows FROM rejected GROUP BY year, reason")
    o["year_replace"] = w("wide", f"""
SELECT year, month, count(*) AS rows FROM wide
WHERE NOT (year = {REPLACE_YEAR} AND month = '{DROPPED_MONTH}') GROUP BY year, month""")
    o["atomic_replace"] = w("stations", "SELECT * FROM stations WHERE wmo_id IS NOT NULL")
    o["load_together"] = w("all", f"""
SELECT CAST(year AS INTEGER) AS year, count(*) AS rows, 'raw_observations' AS model, 'public_raw' AS namespace
FROM wide WHERE year > {FIRST_YEAR} GROUP BY year
UNION ALL SELECT NULL, (SELECT count(*) FROM stations), 'raw_stations', 'public_raw'""")
    o["job_ingest_year"] = w("wide", f"SELECT * FROM wide WHERE year = {REPLACE_YEAR}")
    o["job_rolling_refresh"] = o["duplicate_cells_multi_file"] = o["stream_values"] = w("wide", "SELECT * FROM wide")
    o["backfill_subrange"] = w("wide", f"""
SELECT * FROM wide WHERE NOT (year = {REPLACE_YEAR} AND month = '{DROPPED_MONTH}')""")
    by_reason = f"""
SELECT 'station_days' AS metric, (SELECT count(*) FROM (SELECT DISTINCT id, date FROM prep
   WHERE q_flag IS NULL AND date IS NOT NULL AND year = {REPLACE_YEAR})) AS rows
UNION ALL SELECT 'rejected_' || reason, count(*) FROM rejected WHERE year = {REPLACE_YEAR}{{more}} GROUP BY reason
UNION ALL SELECT 'undated', 0"""
    o["run_metrics_of_run"] = w("rejected", by_reason.format(more=""))
    stray = f"year = {REPLACE_YEAR - 1} AND month = '12'"
    o["ingest_accounting"] = w("rejected", by_reason.format(more=f" OR ({stray})") + f"""
UNION ALL SELECT 'rejected_out_of_window', count(*) FROM prep WHERE q_flag IS NULL AND date IS NOT NULL AND {stray}
HAVING count(*) > 0""")
    o["rerun_diff"] = w("wide", f"""
SELECT *, 'old_only' AS side, CAST(1 AS BIGINT) AS copies FROM wide
WHERE (year = {REPLACE_YEAR} AND month = '{DROPPED_MONTH}')
   OR (year = {REPLACE_YEAR - 1} AND month = '01' AND tmax IS NOT NULL)
UNION ALL
SELECT * REPLACE (tmax + 1 AS tmax), 'new_only', 1 FROM wide
WHERE year = {REPLACE_YEAR - 1} AND month = '01' AND tmax IS NOT NULL""")
    o["rerun_diff_by_partition"] = o["rerun_diff"]
    o["reconcile_extract"] = w("mart", f"""
, x AS (SELECT observation_year, station_count + CASE WHEN observation_year = {REPLACE_YEAR} THEN 1 ELSE 0 END AS station_count,
               avg_tmax_c FROM mart WHERE avg_tmax_c IS NOT NULL)
SELECT m.observation_year, m.station_count AS mart_station_count, x.station_count AS extract_station_count,
       m.station_count - x.station_count AS diff_station_count, m.avg_tmax_c AS mart_avg_tmax_c,
       x.avg_tmax_c AS extract_avg_tmax_c, m.avg_tmax_c - x.avg_tmax_c AS diff_avg_tmax_c
FROM mart m LEFT JOIN x ON m.observation_year = x.observation_year""")
    o["bucketed_fact"] = w("mart", """
SELECT observation_year, station_count, tmax_days, station_days, round(tmax_days / station_days, 3) AS tmax_share,
       avg_tmax_c, avg_tmin_c, avg_tavg_c, avg_prcp_mm, avg_snow_mm, avg_snwd_mm
FROM mart""")
    o["ingest_year"] = w("wide", f"SELECT * FROM wide WHERE year = {REPLACE_YEAR}")
    o["backfill_years"] = w("wide", "SELECT year, count(*) AS count FROM wide GROUP BY year")
    o["rolling_window"] = w("wide", "SELECT year, month, count(*) AS rows FROM wide GROUP BY year, month")
    o["run_metrics"] = w("rejected", """
, wide_n AS (SELECT count(*) AS n FROM (SELECT DISTINCT id, date FROM prep WHERE q_flag IS NULL AND date IS NOT NULL))
SELECT 'station_days' AS metric, (SELECT n FROM wide_n) AS rows
UNION ALL SELECT 'rejected', (SELECT count(*) FROM rejected)""")
    o["stations_build"] = w("stations", "SELECT * FROM stations")
    o["stream_ingest"] = w(
        "wide", "SELECT year, count(*) AS station_days, count(DISTINCT id) AS stations FROM wide GROUP BY year")
    o["star_schema_counts"] = w("all", """
SELECT * FROM (VALUES
 ('raw_stations', (SELECT count(*) FROM stations)),
 ('raw_observations', (SELECT count(*) FROM wide)),
 ('stg_observations', (SELECT count(*) FROM fct)),
 ('stg_stations', (SELECT count(*) FROM dim_station)),
 ('fct_daily_weather', (SELECT count(*) FROM fct)),
 ('dim_station', (SELECT count(*) FROM dim_station)),
 ('dim_date', (SELECT count(*) FROM dim_date)),
 ('mart_yearly_climate', (SELECT count(*) FROM mart))
) AS t(model, rows)""")
    return o

