"""Registered queries over catalog tables: written by one session, read by another."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxstar.operators import models, validation
from wxstar.plans import lake
from wxstar.plans.files import FIRST_YEAR, REPLACE_YEAR, AS_OF, _built_star, _raw, _parts, _without_month, _yearly_files
from wxstar.plans.star import star_from_tables
from wxstar.session import scratch_dir
from wxstar.sinks import catalog, parquet as sinks

REFRESHED = (REPLACE_YEAR, REPLACE_YEAR + 1)
LANDED_ROWS, LANDED_FILES = 1000, 2000  # rows of a landed file here, and files from which on they hold more: a year is many of them
DIGITS = 8  # decimals of plain averages, whose last bits depend on the order of summation


def _namespace(spark) -> tuple[str, str]:
    return f"lake_{uuid.uuid4().hex[:10]}", scratch_dir(spark, "lake")


def _rerun_lake(spark, sf_dir) -> tuple[str, str, str]:
    """All years ingested, then 1998 again from rows where February is gone; (namespace, root, second run)."""
    namespace, root = _namespace(spark)
    raw = _raw(spark, sf_dir)
    lake.ingest_years(raw, namespace, root, range(FIRST_YEAR, AS_OF.year + 1), order_key="src_order")
    run = lake.ingest_years(_without_month(raw).filter(F.substring("date", 1, 4) == str(REPLACE_YEAR)), namespace, root,
                            [REPLACE_YEAR], order_key="src_order")
    return namespace, root, run


def q_lake_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-days of the lake, as a second session reads them by name."""
    namespace, _, _ = _rerun_lake(spark, sf_dir)
    return spark.newSession().table(f"{namespace}.station_days")


def q_lake_quarantine(spark, sf_dir):
    namespace, _, _ = _rerun_lake(spark, sf_dir)
    return spark.newSession().table(f"{namespace}.quarantine").groupBy("year", "month", "reason").agg(F.count("*").alias("rows"))


def q_lake_run_metrics(spark, sf_dir):
    """What the second run's write jobs observed, as kept with the run."""
    namespace, _, run = _rerun_lake(spark, sf_dir)
    return spark.newSession().table(f"{namespace}.run_metrics").filter(F.col("run") == run).select("metric", "rows")


def q_lake_landed(spark, sf_dir):
    """Yearly files with repeated cells over their parts, re-laid into small ordered files, then ingested from these."""
    namespace, root = _namespace(spark)
    raw, years = _raw(spark, sf_dir), range(FIRST_YEAR, AS_OF.year + 1)
    rows = raw.count()
    lake.land(spark, _yearly_files(spark, raw, _parts(rows)), namespace, root, years, rows_per_file=max(LANDED_ROWS, rows // LANDED_FILES))
    lake.ingest_landed(spark, namespace, root, years)
    return spark.newSession().table(f"{namespace}.station_days")


def q_lake_mart_refresh(spark, sf_dir):
    """The mart with plain averages: built for all years, then two of them recomputed after February 1998 went. ``refreshed``
    tells the years whose files changed."""
    namespace, root = _namespace(spark)
    raw, years = _raw(spark, sf_dir), range(FIRST_YEAR, AS_OF.year + 1)
    lake.ingest_years(raw, namespace, root, years, order_key="src_order")
    lake.refresh_mart(spark, namespace, root, years)
    table = f"{namespace}.mart_yearly_climate"
    before = catalog.partition_locations(spark, table, "observation_year")
    changed = _without_month(raw).filter(F.substring("date", 1, 4).isin([str(y) for y in REFRESHED]))
    lake.ingest_years(changed, namespace, root, REFRESHED, order_key="src_order")
    lake.refresh_mart(spark, namespace, root, REFRESHED)
    after = catalog.partition_locations(spark, table, "observation_year")
    moved = [int(y) for y in after if after[y] != before.get(y)]
    mart = spark.newSession().table(table)
    averages = [F.round(name, DIGITS).alias(name) for _, _, name in models.MART_MEASURES]
    return mart.select("observation_year", "station_count", "tmax_days", "station_days", *averages,
                       F.col("observation_year").isin(moved).alias("refreshed"))


def q_marts_by_name(spark, sf_dir):
    """The star schema of a target built twice; a second session counts its models by their names."""
    target = f"t{uuid.uuid4().hex[:8]}"
    marts, staging = (sinks.table_name(layer, target) for layer in ("marts", "staging"))
    for _ in range(2):
        _built_star(spark, sf_dir, target)
    other = spark.newSession()
    names = [f"{staging}.stg_observations", f"{staging}.stg_stations"] + [
        f"{marts}.{m}" for m in ("fct_daily_weather", "dim_station", "dim_date", "mart_yearly_climate")]
    return validation.row_counts({n.split(".")[1]: other.table(n) for n in names})


def q_star_join_bucketed(spark, sf_dir):
    """The star query over a fact and a station dimension bucketed alike."""
    s, root = star_from_tables(spark, sf_dir), scratch_dir(spark, "cobucketed")
    fct, dim = (f"{n}_{uuid.uuid4().hex[:8]}" for n in ("fct", "dim_station"))
    buckets = max(2, sinks.bucket_count(s.fct))
    sinks.write_bucketed_fact(s.fct, fct, buckets, f"{root}/fct")
    sinks.write_bucketed(s.dim_station, dim, "station_id", buckets, path=f"{root}/dim")
    out = models.star_climate_by_province_season(spark.table(fct), spark.table(dim), models.dim_date(spark.table(fct)))
    return out.select(
        "province", "season", "stations", "station_days", "tmax_days", "prcp_days",
        *(F.round(F.col(c) * 10).cast("bigint").alias(n) for c, n in (("sum_tmax_c", "tmax_tenths"), ("sum_prcp_mm", "prcp_tenths"))))


QUERIES = {
    "lake_years": q_lake_years,
    "lake_quarantine": q_lake_quarantine,
    "lake_landed": q_lake_landed,
    "lake_run_metrics": q_lake_run_metrics,
    "lake_mart_refresh": q_lake_mart_refresh,
    "marts_by_name": q_marts_by_name,
    "star_join_bucketed": q_star_join_bucketed,
}


def oracles(w) -> dict[str, str]:
    """Oracle SQL; ``w(chain, body)`` prefixes the adapter CTEs of ``__spark_entry__``."""
    gone = f"year = {REPLACE_YEAR} AND month = '02'"
    # February 1998 is gone by the date text, so a flagged row of it is gone as well
    averages = ",\n       ".join(f"round(avg({c}) FILTER (WHERE NOT gone), {DIGITS}) AS {name}" for c, _, name in models.MART_MEASURES)
    rejected_1998 = f"SELECT * FROM rejected WHERE year = {REPLACE_YEAR} AND month <> '02'"
    return {
        "lake_years": w("wide", f"SELECT * FROM wide WHERE NOT ({gone})"),
        "lake_landed": w("wide", "SELECT * FROM wide"),
        "lake_quarantine": w("rejected", f"""
SELECT CAST(year AS INTEGER) AS year, month, reason, count(*) AS rows FROM rejected WHERE NOT ({gone}) GROUP BY ALL"""),
        "lake_run_metrics": w("rejected", f"""
SELECT 'station_days' AS metric, (SELECT count(*) FROM (SELECT DISTINCT id, date FROM prep
   WHERE q_flag IS NULL AND date IS NOT NULL AND year = {REPLACE_YEAR} AND month <> '02')) AS rows
UNION ALL SELECT 'rejected_' || reason, count(*) FROM ({rejected_1998}) GROUP BY reason
UNION ALL SELECT 'undated', 0"""),
        "lake_mart_refresh": w("fct", f"""
, f AS (SELECT *, year(observation_date) = {REPLACE_YEAR} AND month(observation_date) = 2 AS gone FROM fct)
SELECT CAST(year(observation_date) AS INTEGER) AS observation_year,
       count(DISTINCT station_id) FILTER (WHERE NOT gone) AS station_count,
       count(tmax_c) FILTER (WHERE NOT gone) AS tmax_days, count(*) FILTER (WHERE NOT gone) AS station_days,
       {averages},
       year(observation_date) IN {REFRESHED} AS refreshed
FROM f GROUP BY year(observation_date)"""),
        "marts_by_name": w("all", """
SELECT * FROM (VALUES
 ('stg_observations', (SELECT count(*) FROM fct)), ('stg_stations', (SELECT count(*) FROM dim_station)),
 ('fct_daily_weather', (SELECT count(*) FROM fct)), ('dim_station', (SELECT count(*) FROM dim_station)),
 ('dim_date', (SELECT count(*) FROM dim_date)), ('mart_yearly_climate', (SELECT count(*) FROM mart))) AS t(model, rows)"""),
    }
