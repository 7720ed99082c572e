"""

Every query reads the driver's tables in ``sf_dir`` through the adapters of
``wxstar.sources.tables`` (stations = suppliers, observations = lineitems) and runs the
library's operators over the whole tables. The oracle SQL re-states the same adapter
rules and the same semantics independently, in DuckDB SQL.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable

if os.path.dirname(os.path.abspath(__file__)) not in sys.path:  # loaded by path from elsewhere
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxstar.operators import models, profiling, stations as st_ops, trends, validation
from wxstar.operators.observations import element_units
from wxstar.plans import catalog_queries, files as file_plans
from wxstar.plans.star import star_from_tables
from wxstar.schemas import INVENTORY_LAYOUT, STATIONS_LAYOUT
from wxstar.session import scratch_dir
from wxstar.sources import tables
from wxstar.sources.fixed_width import parse_fixed_width

SMOKE_DIR = "/root/testdata/sf0.001"

# Report parameters for the test tables (ship dates run 1995-01 .. 2001-11, so the last
# year is incomplete; the reference's defaults are 1990/2000/2010-2025 and 2024).
SPAN_STARTS = (1995, 1997, 1999)
SPAN_END = 2001
INCOMPLETE_FROM = 2001
MONTH_YEAR = 1998
ROUND = 4  # decimals of the exact (deterministic) means in the mart-based reports


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------


def _exact_mart(spark, sf_dir):
    """The mart with exact means (rounded half-up to ROUND decimals): deterministic, so
    both engines agree even when a mean falls exactly on a rounding tie."""
    return models.mart_yearly_climate(star_from_tables(spark, sf_dir).fct, exact_digits=ROUND)


def q_yearly_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models.with_tmax_share(_exact_mart(spark, sf_dir))
    avgs = ["avg_tmax_c", "avg_tmin_c", "avg_tavg_c", "avg_prcp_mm", "avg_snow_mm", "avg_snwd_mm"]
    return m.select("observation_year", "station_count", "tmax_days", "station_days", "tmax_share", *avgs)


def q_wide_station_days(spark, sf_dir):
    return star_from_tables(spark, sf_dir).station_days


def q_scaled_elements(spark, sf_dir):
    return element_units(star_from_tables(spark, sf_dir).station_days)


def q_prepare_scope(spark, sf_dir):
    return star_from_tables(spark, sf_dir).prepared


def q_quality_clean(spark, sf_dir):
    return star_from_tables(spark, sf_dir).clean


def q_quality_rejected(spark, sf_dir):
    return star_from_tables(spark, sf_dir).rejected


def q_stg_observations(spark, sf_dir):
    return star_from_tables(spark, sf_dir).fct


def q_stg_stations(spark, sf_dir):
    return star_from_tables(spark, sf_dir).dim_station


def q_dim_date(spark, sf_dir):
    return star_from_tables(spark, sf_dir).dim_date


def q_season_counts(spark, sf_dir):
    d = star_from_tables(spark, sf_dir).dim_date
    return d.groupBy("season").agg(F.count("*").alias("days"))


def q_star_join(spark, sf_dir):
    """Sums are presented as whole tenths: readings are tenths, so these are exact in any
    engine, where a rounded mean can fall on either side of a tie."""
    s = star_from_tables(spark, sf_dir)
    out = models.star_climate_by_province_season(s.fct, s.dim_station, s.dim_date)
    return out.select(
        "province", "season", "stations", "station_days", "tmax_days", "prcp_days",
        F.round(F.col("sum_tmax_c") * 10).cast("bigint").alias("tmax_tenths"),
        F.round(F.col("sum_prcp_mm") * 10).cast("bigint").alias("prcp_tenths"),
    )


def q_stations_by_province(spark, sf_dir):
    return st_ops.stations_by_province(star_from_tables(spark, sf_dir).stations)


def q_station_nulls(spark, sf_dir):
    return st_ops.station_counts(star_from_tables(spark, sf_dir).stations)


def _raw(spark, sf_dir):
    return tables.long_observations(spark, sf_dir)


def q_profile_volume(spark, sf_dir):
    return profiling.volume(_raw(spark, sf_dir))


def q_source_summary(spark, sf_dir):
    return profiling.source_summary(_raw(spark, sf_dir))


def q_country_mix(spark, sf_dir):
    return profiling.country_mix(_raw(spark, sf_dir), top=10)


def q_country_ratio(spark, sf_dir):
    return profiling.country_ratio(_raw(spark, sf_dir))


def q_element_mix(spark, sf_dir):
    return profiling.element_mix(_raw(spark, sf_dir), top=15)


def q_core_element_mix(spark, sf_dir):
    return profiling.core_element_mix(_raw(spark, sf_dir))


def q_flag_mix(spark, sf_dir):
    return profiling.flag_mix(_raw(spark, sf_dir))


def q_failed_qc(spark, sf_dir):
    return profiling.failed_qc(_raw(spark, sf_dir))


def q_date_range(spark, sf_dir):
    return profiling.date_range(_raw(spark, sf_dir))


def q_obs_time_fill(spark, sf_dir):
    return profiling.obs_time_fill(_raw(spark, sf_dir))


def q_value_checks(spark, sf_dir):
    """With the missing-value sentinel planted in every 97th source row."""
    planted = F.when(F.col("src_order") % 97 == 0, F.lit("-9999")).otherwise(F.col("data_value"))
    return profiling.value_checks(_raw(spark, sf_dir).withColumn("data_value", planted))


def q_grain_check(spark, sf_dir):
    return profiling.grain_check(_raw(spark, sf_dir))


def q_fixed_width_stations(spark, sf_dir):
    return parse_fixed_width(tables.station_lines(spark, sf_dir), STATIONS_LAYOUT)


def _inventory(spark, sf_dir):
    return profiling.country_inventory(parse_fixed_width(tables.inventory_lines(spark, sf_dir), INVENTORY_LAYOUT))


def q_fixed_width_inventory(spark, sf_dir):
    return parse_fixed_width(tables.inventory_lines(spark, sf_dir), INVENTORY_LAYOUT, blank_as_null=False)


def q_inventory_summary(spark, sf_dir):
    return profiling.inventory_summary(_inventory(spark, sf_dir))


def q_inventory_elements(spark, sf_dir):
    return profiling.inventory_elements(_inventory(spark, sf_dir))


def q_span_counts(spark, sf_dir):
    return profiling.span_counts(_inventory(spark, sf_dir), starts=SPAN_STARTS, end=SPAN_END)


def q_first_decade(spark, sf_dir):
    return profiling.first_decade_counts(_inventory(spark, sf_dir))


def q_last_year(spark, sf_dir):
    return profiling.last_year_counts(_inventory(spark, sf_dir))


def q_coverage_by_year(spark, sf_dir):
    raw = _raw(spark, sf_dir).withColumn("obs_year", F.substring("date", 1, 4).try_cast("int"))
    return profiling.coverage_by_year(raw, year_col="obs_year")


def q_yoy_change(spark, sf_dir):
    return trends.with_yoy_change(trends.yearly_counts(star_from_tables(spark, sf_dir).station_days))


def q_monthly_counts(spark, sf_dir):
    return trends.monthly_counts(star_from_tables(spark, sf_dir).station_days, MONTH_YEAR)


def q_monthly_counts_nonnull(spark, sf_dir):
    return trends.monthly_counts(star_from_tables(spark, sf_dir).station_days, MONTH_YEAR, non_null="tmax")


def q_low_year(spark, sf_dir):
    return trends.low_year(_exact_mart(spark, sf_dir))


def q_first_last_complete(spark, sf_dir):
    return trends.first_last_complete(star_from_tables(spark, sf_dir).mart, INCOMPLETE_FROM)


def q_incomplete_flag(spark, sf_dir):
    return trends.incomplete_flag(_exact_mart(spark, sf_dir), INCOMPLETE_FROM).select(
        "observation_year", "station_count", "avg_tmax_c", "incomplete"
    )


def q_check_not_null(spark, sf_dir):
    return validation.check_not_null(star_from_tables(spark, sf_dir).prepared, "date")


def q_check_unique(spark, sf_dir):
    return validation.check_unique(star_from_tables(spark, sf_dir).prepared, ["id", "date", "element"])


def q_check_relationships(spark, sf_dir):
    s = star_from_tables(spark, sf_dir)
    return validation.check_relationships(s.raw_observations, "id", s.stations, "id").select(
        "id", "date", "element", "src_order"
    )


def q_check_accepted(spark, sf_dir):
    return validation.check_accepted_values(_raw(spark, sf_dir), "element", profiling.CORE_ELEMENTS)


def q_check_tmax_below_tmin(spark, sf_dir):
    return validation.check_tmax_not_below_tmin(star_from_tables(spark, sf_dir).fct)


def q_calendar_gaps(spark, sf_dir):
    return validation.calendar_gaps(star_from_tables(spark, sf_dir).fct)


def q_data_tests(spark, sf_dir):
    """The 26 tests over the star built from the tables. The two raw tables are
    checkpointed (reliably, to the shared checkpoint folder) so the tests read them
    instead of re-deriving the pivot in every branch."""
    scratch_dir(spark)  # ensures a checkpoint folder where the session has none
    s = star_from_tables(spark, sf_dir)
    raw_obs = s.raw_obs_table.checkpoint()
    stations = s.stations.checkpoint()
    fct = models.fct_daily_weather(models.stg_observations(raw_obs))
    dim_st = models.dim_station(models.stg_stations(stations))
    return validation.run_data_tests(
        stations, raw_obs, models.dim_date(fct), dim_st, fct, models.mart_yearly_climate(fct)
    )


def _planted(df: DataFrame, *plants: tuple[str, dict]) -> DataFrame:
    """``df`` and, for each plant, its rows that meet a condition once more with some columns changed."""
    out = df
    for condition, changes in plants:
        out = out.unionByName(df.filter(condition).withColumns(
            {c: F.expr(v).cast(df.schema[c].dataType) for c, v in changes.items()}))
    return out


def q_data_tests_planted(spark, sf_dir):
    """The 26 tests over tables with violations of every one of them, each test with a number of its own."""
    scratch_dir(spark)
    s = star_from_tables(spark, sf_dir)
    raw_obs, stations = s.raw_obs_table.checkpoint(), s.stations.checkpoint()
    fct = models.fct_daily_weather(models.stg_observations(raw_obs))
    dim_st, dim_dt = models.dim_station(models.stg_stations(stations)), models.dim_date(fct)
    return validation.run_data_tests(
        _planted(stations, *PLANTED["stations"]), _planted(raw_obs, *PLANTED["wide"]), _planted(dim_dt, *PLANTED["dim_date"]),
        _planted(dim_st, *PLANTED["dim_station"]), _planted(fct, *PLANTED["fct"]),
        _planted(models.mart_yearly_climate(fct), *PLANTED["mart"]))


# Violations by table: rows that meet a condition, once more with these columns changed. Conditions are SQL that both
# engines read.
PLANTED = {
    "stations": [("true", {}), *[("true", {"id": "NULL"})] * 2],
    "wide": [("month(date) = 1", {"id": "NULL"}), ("month(date) IN (2, 3)", {"date": "NULL"}),
             ("day(date) = 7", {"id": "concat(id, 'x')"})],
    "dim_date": [("day = 1", {}), ("day = 2 AND month < 7", {"date_day": "NULL"}), ("day < 12", {"year": "NULL", "date_day": "NULL"}),
                 ("day < 20 AND month < 8", {"month": "NULL", "date_day": "NULL"}), ("day = 5 AND month < 4", {"day": "NULL", "date_day": "NULL"}),
                 ("day = 6 AND month < 3", {"season": "concat('s', month)", "date_day": "NULL"})],
    "dim_station": [("true", {}), *[("true", {"latitude": "NULL", "station_id": "NULL"})] * 3,
                    *[("true", {"longitude": "NULL", "station_id": "NULL"})] * 4, *[("true", {"elevation_m": "NULL", "station_id": "NULL"})] * 5,
                    *[("true", {"station_name": "NULL", "station_id": "NULL"})] * 6],
    "fct": [("month(observation_date) = 4", {"station_id": "NULL"}), ("month(observation_date) IN (5, 6)", {"observation_date": "NULL"}),
            ("day(observation_date) = 8", {"station_id": "concat(station_id, 'y')"}),
            ("day(observation_date) IN (9, 10)", {"observation_date": "observation_date + INTERVAL 40 YEAR"}),
            ("tmax_c IS NOT NULL AND day(observation_date) > 20", {"tmin_c": "tmax_c + 1"})],
    "mart": [("observation_year > 1995", {"observation_year": "NULL"}), ("observation_year > 1996", {"station_count": "NULL"}),
             ("observation_year > 1997", {"tmax_days": "NULL"}), ("observation_year > 1998", {"station_days": "NULL"})],
}


def q_reconcile_years(spark, sf_dir):
    """Mart counts against counts profiled directly from the clean long rows."""
    s = star_from_tables(spark, sf_dir)
    profiled = profiling.yearly_station_days(s.clean)
    return validation.reconcile(s.mart, profiled, "observation_year", ["station_count", "station_days"],
                                "mart", "profile")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "yearly_mart": q_yearly_mart,
    "wide_station_days": q_wide_station_days,
    "scaled_elements": q_scaled_elements,
    "prepare_scope": q_prepare_scope,
    "quality_clean": q_quality_clean,
    "quality_rejected": q_quality_rejected,
    "stg_observations": q_stg_observations,
    "stg_stations": q_stg_stations,
    "dim_date": q_dim_date,
    "season_counts": q_season_counts,
    "star_join": q_star_join,
    "stations_by_province": q_stations_by_province,
    "station_nulls": q_station_nulls,
    "profile_volume": q_profile_volume,
    "source_summary": q_source_summary,
    "country_mix": q_country_mix,
    "country_ratio": q_country_ratio,
    "element_mix": q_element_mix,
    "core_element_mix": q_core_element_mix,
    "flag_mix": q_flag_mix,
    "failed_qc": q_failed_qc,
    "date_range": q_date_range,
    "obs_time_fill": q_obs_time_fill,
    "value_checks": q_value_checks,
    "grain_check": q_grain_check,
    "fixed_width_stations": q_fixed_width_stations,
    "fixed_width_inventory": q_fixed_width_inventory,
    "inventory_summary": q_inventory_summary,
    "inventory_elements": q_inventory_elements,
    "span_counts": q_span_counts,
    "first_decade": q_first_decade,
    "last_year": q_last_year,
    "coverage_by_year": q_coverage_by_year,
    "yoy_change": q_yoy_change,
    "monthly_counts": q_monthly_counts,
    "monthly_counts_nonnull": q_monthly_counts_nonnull,
    "low_year": q_low_year,
    "first_last_complete": q_first_last_complete,
    "incomplete_flag": q_incomplete_flag,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_relationships": q_check_relationships,
    "check_accepted": q_check_accepted,
    "check_tmax_below_tmin": q_check_tmax_below_tmin,
    "calendar_gaps": q_calendar_gaps,
    "data_tests": q_data_tests,
    "data_tests_planted": q_data_tests_planted,
    "reconcile_years": q_reconcile_years,
}
_QUERIES.update(file_plans.QUERIES)
_QUERIES.update(catalog_queries.QUERIES)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: raw lineitem-derived observations -> prepare -> quality split -> pivot ->
    scale -> star schema -> yearly mart, on sf0.001."""
    return q_yearly_mart(spark, SMOKE_DIR)


def _llm():
    """The training-data subpackage and its pipeline; None where they, or something they need, are not installed."""
    try:
        import corpus_pipeline
        import wxstar.llm.queries as llm_queries
    except ImportError:
        return None
    return llm_queries, corpus_pipeline


def _with_package(query):
    """Python workers import the package from here when it isn't installed on them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.abspath(__file__)))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(_QUERIES)
    if llm := _llm():
        out.update({name: _with_package(q) for name, q in (llm[0].QUERIES | {"pipeline": llm[1].run}).items()})
    return out


# ---------------------------------------------------------------------------
# oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

_ELEMENTS_SQL = "('TMAX','TMIN','PRCP','TAVG','SNOW','SNWD')"

# The adapter rules of wxstar.sources.tables, restated in SQL.
_ST = """
st AS (
  SELECT s.s_suppkey,
         ['AG','AR','BR','CA','EG','ET','FR','GM','IN','ID','IR','IZ','JA',
          'JO','KE','MO','MZ','PE','CH','RO','SA','VM','RS','UK','US'][s.s_nationkey + 1]
           || lpad(CAST(s.s_suppkey AS VARCHAR), 9, '0') AS id,
         CAST(CAST(42 + s.s_acctbal / 1000 AS DECIMAL(8,5)) AS VARCHAR) AS latitude,
         CAST(CAST(-60 - s.s_acctbal / 1000 AS DECIMAL(8,5)) AS VARCHAR) AS longitude,
         CAST(CAST(floor(s.s_acctbal / 10) AS BIGINT) AS VARCHAR) AS elevation,
         ['AB','BC','MB','NB','NL','NS','NT','NU','ON','PE','QC','SK','YT'][least(CAST(floor((s.s_acctbal + 1000) / 850) AS INTEGER) + 1, 13)] AS state,
         s.s_name AS name,
         CASE WHEN s.s_acctbal > 9000 THEN 'GSN' ELSE '' END AS gsn_flag,
         CASE WHEN s.s_acctbal BETWEEN 0 AND 1000 THEN 'HCN' ELSE '' END AS hcn_crn_flag,
         CASE WHEN s.s_acctbal >= 0 THEN lpad(CAST(s.s_suppkey AS VARCHAR), 5, '0') ELSE '' END AS wmo_id
  FROM supplier s
)"""

_LINES = """
lines AS (
  SELECT rtrim(rpad(id, 11, ' ') || ' ' || lpad(latitude, 8, ' ') || ' ' || lpad(longitude, 9, ' ') || ' '
         || lpad(elevation, 6, ' ') || ' ' || rpad(state, 2, ' ') || ' ' || rpad(name, 30, ' ') || ' '
         || rpad(gsn_flag, 3, ' ') || ' ' || rpad(hcn_crn_flag, 3, ' ') || ' ' || rpad(wmo_id, 5, ' ')) AS value
  FROM st
)"""

_FW = "nullif(trim(substr(value, {s}, {n})), '')"
_STATIONS_TEXT = (
    "\nstations_text AS (\n  SELECT "
    + ", ".join(f"{_FW.format(s=s, n=e - s + 1)} AS {name}" for name, s, e in STATIONS_LAYOUT)
    + "\n  FROM lines\n)"
)

_STATIONS = """
stations AS (
  SELECT id, TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
         TRY_CAST(elevation AS DOUBLE) AS elevation, state, name, gsn_flag, hcn_crn_flag, wmo_id
  FROM stations_text WHERE starts_with(id, 'CA')
)"""

_RAW = """
raw AS (
  SELECT st.id,
         CASE WHEN l.l_discount = 0.10 AND l.l_tax = 0.0 THEN strftime(l.l_shipdate, '%Y') || '0230'
              ELSE strftime(l.l_shipdate, '%Y%m%d') END AS date,
         ['TMAX','TMIN','PRCP','TAVG','SNOW','SNWD','WT01'][l.l_linenumber] AS element,
         CASE WHEN l.l_discount = 0.0 AND l.l_tax = 0.08 THEN 'n/a'
              ELSE CAST(CAST(l.l_quantity AS INTEGER) * 10 - 250 + CAST(round(l.l_discount * 100) AS INTEGER) AS VARCHAR)
         END AS data_value,
         CAST(NULL AS VARCHAR) AS m_flag,
         CASE WHEN l.l_returnflag = 'R' AND l.l_tax = 0.08 THEN 'X'
              WHEN l.l_returnflag = 'A' AND l.l_tax = 0.0 THEN '' END AS q_flag,
         l.l_linestatus AS s_flag,
         CASE WHEN l.l_returnflag = 'N' THEN strftime(l.l_shipdate, '%H%M') END AS obs_time,
         l.l_orderkey * 8 + l.l_linenumber AS src_order
  FROM lineitem l JOIN st ON l.l_suppkey = st.s_suppkey
)"""

_PREP = f"""
prep AS (
  SELECT id, CAST(try_strptime(date, '%Y%m%d') AS DATE) AS date, element,
         TRY_CAST(data_value AS INTEGER) AS data_value, m_flag, nullif(trim(q_flag), '') AS q_flag,
         s_flag, obs_time, src_order,
         CAST(coalesce(year(try_strptime(date, '%Y%m%d')), TRY_CAST(substr(date, 1, 4) AS INTEGER)) AS INTEGER) AS year,
         coalesce(strftime(try_strptime(date, '%Y%m%d'), '%m'), nullif(substr(date, 5, 2), '')) AS month
  FROM raw WHERE starts_with(id, 'CA') AND element IN {_ELEMENTS_SQL}
)"""

_CLEAN = """
clean AS (SELECT * FROM prep WHERE q_flag IS NULL AND date IS NOT NULL)"""

_REJECTED = """
rejected AS (
  SELECT *, CASE WHEN date IS NULL THEN 'bad_date' ELSE 'q_flag' END AS reason
  FROM prep WHERE q_flag IS NOT NULL OR date IS NULL
)"""


def _cell(e: str, scale: bool) -> str:
    v = f"arg_min_null(data_value, src_order) FILTER (WHERE element = '{e}')"
    return f"{v} / 10" if scale else v


_WIDE = f"""
wide AS (
  SELECT id, date,
         {_cell('TMAX', True)} AS tmax, {_cell('TMIN', True)} AS tmin,
         {_cell('PRCP', True)} AS prcp, {_cell('TAVG', True)} AS tavg,
         {_cell('SNOW', False)} AS snow, {_cell('SNWD', False)} AS snwd,
         CAST(year(date) AS INTEGER) AS year, strftime(date, '%m') AS month
  FROM clean GROUP BY id, date
)"""

_FCT = """
fct AS (
  SELECT id AS station_id, date AS observation_date, tmax AS tmax_c, tmin AS tmin_c, tavg AS tavg_c,
         prcp AS prcp_mm, snow AS snow_fall_mm, snwd AS snwd_depth_mm
  FROM wide
)"""

_DIM_STATION = """
dim_station AS (
  SELECT id AS station_id, latitude, longitude, elevation AS elevation_m, state AS province,
         name AS station_name, gsn_flag, hcn_crn_flag, wmo_id
  FROM stations
)"""

_DIM_DATE = """
dim_date AS (
  SELECT date_day, CAST(year(date_day) AS INTEGER) AS year, CAST(month(date_day) AS INTEGER) AS month,
         CAST(day(date_day) AS INTEGER) AS day,
         CASE WHEN month(date_day) BETWEEN 3 AND 5 THEN 'spring'
              WHEN month(date_day) BETWEEN 6 AND 8 THEN 'summer'
              WHEN month(date_day) BETWEEN 9 AND 11 THEN 'fall' ELSE 'winter' END AS season
  FROM (SELECT DISTINCT observation_date AS date_day FROM fct)
)"""

def _exact_mean_sql(c: str, units: int, digits: int = ROUND) -> str:
    s = f"sum(CAST(round({c} * {units}) AS BIGINT))"
    n = f"count({c})"
    return (f"CASE WHEN {n} > 0 THEN CAST(sign({s}) * ((abs({s}) * {2 * 10 ** digits // units} + {n}) // (2 * {n})) "
            f"AS DOUBLE) / {float(10 ** digits)} END")


_MART = f"""
mart AS (
  SELECT CAST(year(observation_date) AS INTEGER) AS observation_year,
         count(DISTINCT station_id) AS station_count, count(tmax_c) AS tmax_days, count(station_id) AS station_days,
         {_exact_mean_sql('tmax_c', 10)} AS avg_tmax_c, {_exact_mean_sql('tmin_c', 10)} AS avg_tmin_c,
         {_exact_mean_sql('tavg_c', 10)} AS avg_tavg_c, {_exact_mean_sql('prcp_mm', 10)} AS avg_prcp_mm,
         {_exact_mean_sql('snow_fall_mm', 1)} AS avg_snow_mm, {_exact_mean_sql('snwd_depth_mm', 1)} AS avg_snwd_mm
  FROM fct GROUP BY 1
)"""

_INV_LINES = """
inv_lines AS (
  SELECT rpad(st.id, 11, ' ') || ' ' || lpad(st.latitude, 8, ' ') || ' ' || lpad(st.longitude, 9, ' ') || ' '
         || rpad(sp.element, 4, ' ') || ' ' || CAST(sp.first_year AS VARCHAR) || ' ' || CAST(sp.last_year AS VARCHAR) AS value
  FROM (SELECT l_suppkey, ['TMAX','TMIN','PRCP','TAVG','SNOW','SNWD','WT01'][l_linenumber] AS element,
               min(year(l_shipdate)) AS first_year, max(year(l_shipdate)) AS last_year
        FROM lineitem GROUP BY 1, 2) sp
  JOIN st ON sp.l_suppkey = st.s_suppkey
)"""

_INV = f"""
inv AS (
  SELECT id, latitude, longitude, element, TRY_CAST(first_year AS INTEGER) AS first_year,
         TRY_CAST(last_year AS INTEGER) AS last_year
  FROM (SELECT {", ".join(f"{_FW.format(s=s, n=e - s + 1)} AS {name}" for name, s, e in INVENTORY_LAYOUT)}
        FROM inv_lines)
  WHERE starts_with(id, 'CA')
)"""

_CHAINS = {
    "st": [_ST],
    "lines": [_ST, _LINES],
    "stations": [_ST, _LINES, _STATIONS_TEXT, _STATIONS],
    "raw": [_ST, _RAW],
    "prep": [_ST, _RAW, _PREP],
    "clean": [_ST, _RAW, _PREP, _CLEAN],
    "rejected": [_ST, _RAW, _PREP, _REJECTED],
    "wide": [_ST, _RAW, _PREP, _CLEAN, _WIDE],
    "fct": [_ST, _RAW, _PREP, _CLEAN, _WIDE, _FCT],
    "dims": [_ST, _LINES, _STATIONS_TEXT, _STATIONS, _RAW, _PREP, _CLEAN, _WIDE, _FCT, _DIM_STATION, _DIM_DATE],
    "mart": [_ST, _RAW, _PREP, _CLEAN, _WIDE, _FCT, _MART],
    "all": [_ST, _LINES, _STATIONS_TEXT, _STATIONS, _RAW, _PREP, _CLEAN, _WIDE, _FCT, _DIM_STATION, _DIM_DATE, _MART],
    "inv": [_ST, _INV_LINES, _INV],
}


def _with(chain: str, body: str) -> str:
    return "WITH " + ",".join(_CHAINS[chain]) + "\n" + body


def _pct(part: str, whole: str, digits: int) -> str:
    return f"round({part} * 100.0 / {whole}, {digits})"


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["yearly_mart"] = _with("mart", f"""
SELECT observation_year, station_count, tmax_days, station_days,
       round(tmax_days / station_days, 3) AS tmax_share,
       avg_tmax_c, avg_tmin_c, avg_tavg_c, avg_prcp_mm, avg_snow_mm, avg_snwd_mm
FROM mart""")
    o["wide_station_days"] = _with("wide", "SELECT * FROM wide")
    o["scaled_elements"] = _with("wide", " UNION ALL ".join(
        f"SELECT '{c}' AS element, {d} AS divisor, count({c}) AS cells, "
        f"CAST(round(coalesce(sum({c}), 0) * 10) AS BIGINT) AS value_tenths FROM wide"
        for c, d in (("tmax", 10), ("tmin", 10), ("prcp", 10), ("tavg", 10), ("snow", 1), ("snwd", 1))))
    o["prepare_scope"] = _with("prep", "SELECT * FROM prep")
    o["quality_clean"] = _with("clean", "SELECT * FROM clean")
    o["quality_rejected"] = _with("rejected", "SELECT * FROM rejected")
    o["stg_observations"] = _with("fct", "SELECT * FROM fct")
    o["stg_stations"] = _with("dims", "SELECT * FROM dim_station")
    o["dim_date"] = _with("dims", "SELECT * FROM dim_date")
    o["season_counts"] = _with("dims", "SELECT season, count(*) AS days FROM dim_date GROUP BY season")
    o["star_join"] = _with("dims", """
SELECT s.province, d.season, count(DISTINCT f.station_id) AS stations, count(*) AS station_days,
       count(f.tmax_c) AS tmax_days, count(f.prcp_mm) AS prcp_days,
       CAST(round(sum(f.tmax_c) * 10) AS BIGINT) AS tmax_tenths, CAST(round(sum(f.prcp_mm) * 10) AS BIGINT) AS prcp_tenths
FROM fct f JOIN dim_date d ON f.observation_date = d.date_day JOIN dim_station s ON f.station_id = s.station_id
GROUP BY s.province, d.season""")
    o["stations_by_province"] = _with("stations", "SELECT state, count(*) AS stations FROM stations GROUP BY state")
    o["station_nulls"] = _with(
        "stations", "SELECT count(*) AS stations, count(*) FILTER (WHERE wmo_id IS NULL) AS wmo_null FROM stations")
    o["profile_volume"] = _with(
        "raw", "SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT id FROM raw)) AS stations FROM raw")
    o["source_summary"] = _with("raw", """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT id FROM raw)) AS stations,
       count(*) FILTER (WHERE q_flag IS NOT NULL AND q_flag <> '') AS failed_qc,
       count(*) FILTER (WHERE data_value = '-9999') AS sentinel_rows,
       count(*) FILTER (WHERE TRY_CAST(data_value AS INTEGER) IS NULL) AS non_numeric,
       min(date) AS min_date, max(date) AS max_date,
       count(*) FILTER (WHERE obs_time IS NOT NULL AND obs_time <> '') AS with_obs_time
FROM raw""")
    o["country_mix"] = _with("raw", f"""
SELECT country, rows, stations, {_pct('rows', 'sum(rows) OVER ()', 2)} AS pct_rows
FROM (SELECT substr(id, 1, 2) AS country, count(*) AS rows, count(DISTINCT id) AS stations FROM raw GROUP BY 1)
ORDER BY rows DESC, country NULLS FIRST LIMIT 10""")
    o["country_ratio"] = _with("raw", f"""
SELECT * FROM (
  SELECT country, rows, stations, {_pct('rows', 'sum(rows) OVER ()', 2)} AS pct_rows,
         round(sum(rows) OVER () / rows, 1) AS full_to_country
  FROM (SELECT substr(id, 1, 2) AS country, count(*) AS rows, count(DISTINCT id) AS stations FROM raw GROUP BY 1))
WHERE country = 'CA'""")
    o["element_mix"] = _with("raw", f"""
SELECT element, rows, {_pct('rows', 'sum(rows) OVER ()', 2)} AS pct
FROM (SELECT element, count(*) AS rows FROM raw GROUP BY 1)
ORDER BY rows DESC, element NULLS FIRST LIMIT 15""")
    o["core_element_mix"] = _with("raw", f"""
SELECT element, count(*) AS rows, count(DISTINCT id) AS stations FROM raw
WHERE starts_with(id, 'CA') AND element IN {_ELEMENTS_SQL} GROUP BY element""")
    o["flag_mix"] = _with("raw", f"""
SELECT q_flag, rows, {_pct('rows', 'sum(rows) OVER ()', 4)} AS pct
FROM (SELECT q_flag, count(*) AS rows FROM raw GROUP BY 1)""")
    o["failed_qc"] = _with("raw", f"""
SELECT failed, rows, {_pct('failed', 'rows', 4)} AS pct FROM (
  SELECT count(*) FILTER (WHERE q_flag IS NOT NULL AND q_flag <> '') AS failed, count(*) AS rows FROM raw)""")
    o["date_range"] = _with("raw", "SELECT min(date) AS min_date, max(date) AS max_date FROM raw")
    o["obs_time_fill"] = _with("raw", """
SELECT count(*) AS total,
       CAST(sum(CASE WHEN obs_time IS NOT NULL AND obs_time <> '' THEN 1 ELSE 0 END) AS BIGINT) AS with_obs_time
FROM raw""")
    o["value_checks"] = _with("raw", """
SELECT count(*) FILTER (WHERE data_value = '-9999') AS sentinel_rows,
       count(*) FILTER (WHERE TRY_CAST(data_value AS INTEGER) IS NULL) AS non_numeric
FROM (SELECT CASE WHEN src_order % 97 = 0 THEN '-9999' ELSE data_value END AS data_value FROM raw)""")
    o["grain_check"] = _with("raw", f"""
, sc AS (SELECT * FROM raw WHERE starts_with(id, 'CA') AND element IN {_ELEMENTS_SQL})
SELECT 'whole' AS scope, (SELECT count(*) FROM raw) AS rows,
       (SELECT count(*) FROM (SELECT DISTINCT id, date, element FROM raw)) AS distinct_keys,
       (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT id, date, element FROM raw)) AS duplicates,
       (SELECT count(*) FROM (SELECT DISTINCT id, date FROM raw)) AS station_days
UNION ALL
SELECT 'pipeline', (SELECT count(*) FROM sc),
       (SELECT count(*) FROM (SELECT DISTINCT id, date, element FROM sc)),
       (SELECT count(*) FROM sc) - (SELECT count(*) FROM (SELECT DISTINCT id, date, element FROM sc)),
       (SELECT count(*) FROM (SELECT DISTINCT id, date FROM sc))""")
    o["fixed_width_stations"] = _with("lines", "SELECT " + ", ".join(
        f"{_FW.format(s=s, n=e - s + 1)} AS {name}" for name, s, e in STATIONS_LAYOUT) + " FROM lines")
    o["fixed_width_inventory"] = _with("inv", "SELECT " + ", ".join(
        f"trim(substr(value, {s}, {e - s + 1})) AS {name}" for name, s, e in INVENTORY_LAYOUT) + " FROM inv_lines")
    o["inventory_summary"] = _with(
        "inv", "SELECT count(*) AS pairs, (SELECT count(*) FROM (SELECT DISTINCT id FROM inv)) AS stations FROM inv")
    o["inventory_elements"] = _with("inv", f"""
SELECT element, count(DISTINCT id) AS stations, min(first_year) AS earliest, max(last_year) AS latest
FROM inv WHERE element IN {_ELEMENTS_SQL} GROUP BY element""")
    o["span_counts"] = _with("inv", " UNION ALL ".join(
        f"SELECT {s} AS start_year, {SPAN_END} AS end_year, count(*) FILTER (WHERE first_year <= {s} "
        f"AND last_year >= {SPAN_END}) AS stations FROM inv WHERE element = 'TMAX'"
        for s in SPAN_STARTS))
    o["first_decade"] = _with("inv", """
SELECT CAST(floor(first_year / 10) * 10 AS INTEGER) AS first_decade, count(*) AS stations
FROM inv WHERE element = 'TMAX' GROUP BY 1""")
    o["last_year"] = _with(
        "inv", "SELECT last_year, count(*) AS stations FROM inv WHERE element = 'TMAX' GROUP BY 1")
    o["coverage_by_year"] = _with("raw", f"""
, y AS (SELECT TRY_CAST(substr(date, 1, 4) AS INTEGER) AS year, * FROM raw)
SELECT year, count(*) AS total_rows, count(*) FILTER (WHERE starts_with(id, 'CA')) AS ca_rows,
       count(DISTINCT id) FILTER (WHERE starts_with(id, 'CA')) AS ca_stations,
       count(DISTINCT id) FILTER (WHERE starts_with(id, 'CA') AND element = 'TMAX') AS tmax_stations,
       count(DISTINCT id) FILTER (WHERE starts_with(id, 'CA') AND element = 'PRCP') AS prcp_stations,
       count(DISTINCT id) FILTER (WHERE starts_with(id, 'CA') AND element = 'TAVG') AS tavg_stations,
       {_pct("count(*) FILTER (WHERE starts_with(id, 'CA'))", 'count(*)', 2)} AS ca_pct
FROM y GROUP BY year""")
    o["yoy_change"] = _with("wide", """
SELECT year, count, lag(count) OVER (ORDER BY year) AS previous_year_count,
       round((count - lag(count) OVER (ORDER BY year)) / lag(count) OVER (ORDER BY year) * 100, 2) AS change_pct
FROM (SELECT year, count(*) AS count FROM wide GROUP BY year)""")
    o["monthly_counts"] = _with(
        "wide", f"SELECT month, count(*) AS count FROM wide WHERE year = {MONTH_YEAR} GROUP BY month")
    o["monthly_counts_nonnull"] = _with(
        "wide", f"SELECT month, count(*) AS count FROM wide WHERE year = {MONTH_YEAR} AND tmax IS NOT NULL GROUP BY month")
    o["low_year"] = _with("mart", f"""
SELECT observation_year, avg_tmax_c FROM mart
WHERE avg_tmax_c IS NOT NULL ORDER BY avg_tmax_c, observation_year LIMIT 1""")
    o["first_last_complete"] = _with("mart", f"""
SELECT min(observation_year) AS first_year, arg_min(station_count, observation_year) AS first_station_count,
       {INCOMPLETE_FROM - 1} AS last_complete_year,
       max(station_count) FILTER (WHERE observation_year = {INCOMPLETE_FROM - 1}) AS last_complete_station_count
FROM mart""")
    o["incomplete_flag"] = _with("mart", f"""
SELECT observation_year, station_count, avg_tmax_c, observation_year >= {INCOMPLETE_FROM} AS incomplete
FROM mart""")
    o["check_not_null"] = _with("prep", "SELECT * FROM prep WHERE date IS NULL")
    o["check_unique"] = _with("prep", """
SELECT id, date, element, count(*) AS n_records FROM prep
WHERE id IS NOT NULL AND date IS NOT NULL AND element IS NOT NULL
GROUP BY id, date, element HAVING count(*) > 1""")
    o["check_relationships"] = "WITH " + ",".join([_ST, _LINES, _STATIONS_TEXT, _STATIONS, _RAW]) + """
SELECT r.id, r.date, r.element, r.src_order FROM raw r
WHERE r.id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stations s WHERE s.id = r.id)"""
    o["check_accepted"] = _with("raw", f"""
SELECT element, count(*) AS n_records FROM raw
WHERE element IS NOT NULL AND element NOT IN {_ELEMENTS_SQL} GROUP BY element""")
    o["check_tmax_below_tmin"] = _with(
        "fct", "SELECT station_id, observation_date, tmax_c, tmin_c FROM fct WHERE tmax_c < tmin_c")
    o["calendar_gaps"] = _with("fct", """
SELECT CAST(d AS DATE) AS missing_date
FROM (SELECT unnest(generate_series(min(observation_date), max(observation_date), INTERVAL 1 DAY)) AS d FROM fct)
WHERE CAST(d AS DATE) NOT IN (SELECT observation_date FROM fct)""")
    o["data_tests"] = _with("all", """
SELECT * FROM (VALUES
 ('not_null_raw_stations_id', 'raw_stations', 'id', (SELECT count(*) FROM stations WHERE id IS NULL)),
 ('unique_raw_stations_id', 'raw_stations', 'id',
   (SELECT count(*) FROM (SELECT id FROM stations WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1))),
 ('not_null_raw_observations_id', 'raw_observations', 'id', (SELECT count(*) FROM wide WHERE id IS NULL)),
 ('not_null_raw_observations_date', 'raw_observations', 'date', (SELECT count(*) FROM wide WHERE date IS NULL)),
 ('relationships_raw_observations_id', 'raw_observations', 'id',
   (SELECT count(*) FROM wide w WHERE w.id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stations s WHERE s.id = w.id))),
 ('unique_dim_date_date_day', 'dim_date', 'date_day',
   (SELECT count(*) FROM (SELECT date_day FROM dim_date WHERE date_day IS NOT NULL GROUP BY date_day HAVING count(*) > 1))),
 ('not_null_dim_date_date_day', 'dim_date', 'date_day', (SELECT count(*) FROM dim_date WHERE date_day IS NULL)),
 ('not_null_dim_date_year', 'dim_date', 'year', (SELECT count(*) FROM dim_date WHERE year IS NULL)),
 ('not_null_dim_date_month', 'dim_date', 'month', (SELECT count(*) FROM dim_date WHERE month IS NULL)),
 ('not_null_dim_date_day', 'dim_date', 'day', (SELECT count(*) FROM dim_date WHERE day IS NULL)),
 ('accepted_values_dim_date_season', 'dim_date', 'season',
   (SELECT count(DISTINCT season) FROM dim_date WHERE season NOT IN ('winter','spring','summer','fall'))),
 ('unique_dim_station_station_id', 'dim_station', 'station_id',
   (SELECT count(*) FROM (SELECT station_id FROM dim_station WHERE station_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1))),
 ('not_null_dim_station_station_id', 'dim_station', 'station_id', (SELECT count(*) FROM dim_station WHERE station_id IS NULL)),
 ('not_null_dim_station_latitude', 'dim_station', 'latitude', (SELECT count(*) FROM dim_station WHERE latitude IS NULL)),
 ('not_null_dim_station_longitude', 'dim_station', 'longitude', (SELECT count(*) FROM dim_station WHERE longitude IS NULL)),
 ('not_null_dim_station_elevation_m', 'dim_station', 'elevation_m', (SELECT count(*) FROM dim_station WHERE elevation_m IS NULL)),
 ('not_null_dim_station_station_name', 'dim_station', 'station_name', (SELECT count(*) FROM dim_station WHERE station_name IS NULL)),
 ('not_null_fct_daily_weather_station_id', 'fct_daily_weather', 'station_id', (SELECT count(*) FROM fct WHERE station_id IS NULL)),
 ('not_null_fct_daily_weather_observation_date', 'fct_daily_weather', 'observation_date',
   (SELECT count(*) FROM fct WHERE observation_date IS NULL)),
 ('relationships_fct_daily_weather_station_id', 'fct_daily_weather', 'station_id',
   (SELECT count(*) FROM fct f WHERE f.station_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_station s WHERE s.station_id = f.station_id))),
 ('relationships_fct_daily_weather_observation_date', 'fct_daily_weather', 'observation_date',
   (SELECT count(*) FROM fct f WHERE f.observation_date IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_day = f.observation_date))),
 ('not_null_mart_yearly_climate_observation_year', 'mart_yearly_climate', 'observation_year',
   (SELECT count(*) FROM mart WHERE observation_year IS NULL)),
 ('not_null_mart_yearly_climate_station_count', 'mart_yearly_climate', 'station_count',
   (SELECT count(*) FROM mart WHERE station_count IS NULL)),
 ('not_null_mart_yearly_climate_tmax_days', 'mart_yearly_climate', 'tmax_days', (SELECT count(*) FROM mart WHERE tmax_days IS NULL)),
 ('not_null_mart_yearly_climate_station_days', 'mart_yearly_climate', 'station_days',
   (SELECT count(*) FROM mart WHERE station_days IS NULL)),
 ('assert_tmax_not_below_tmin', 'fct_daily_weather', 'tmax_c', (SELECT count(*) FROM fct WHERE tmax_c < tmin_c))
) AS t(test_name, model, column_name, failures)""")
    o["reconcile_years"] = _with("mart", """
, prof AS (SELECT year AS observation_year, count(DISTINCT id) AS station_count,
                  count(DISTINCT (id, date)) AS station_days FROM clean GROUP BY year)
SELECT coalesce(m.observation_year, p.observation_year) AS observation_year,
       m.station_count AS mart_station_count, p.station_count AS profile_station_count,
       m.station_count - p.station_count AS diff_station_count,
       m.station_days AS mart_station_days, p.station_days AS profile_station_days,
       m.station_days - p.station_days AS diff_station_days
FROM mart m FULL OUTER JOIN prof p ON m.observation_year = p.observation_year""")
    o.update(file_plans.oracles(_with))
    o.update(catalog_queries.oracles(_with))
    o["star_join_bucketed"] = o["star_join"]
    o["star_data_tests"] = o["data_tests"]
    o["data_tests_planted"] = _planted_sql(o["data_tests"])
    return o


def _planted_sql(tests: str) -> str:
    """The tests' SQL over the tables with ``PLANTED`` rows: each table is renamed and its planted form takes its name."""
    planted = "".join(
        f",\np_{table} AS (SELECT * FROM {table}" + "".join(
            f"\n  UNION ALL SELECT * REPLACE ({', '.join(f'{v} AS {c}' for c, v in changes.items())}) FROM {table} WHERE {cond}"
            if changes else f"\n  UNION ALL SELECT * FROM {table} WHERE {cond}" for cond, changes in plants) + ")"
        for table, plants in PLANTED.items())
    head, body = tests.split("\nSELECT * FROM (VALUES", 1)
    for table in PLANTED:
        body = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 p_{table}", body)
    return f"{head}{planted}\nSELECT * FROM (VALUES{body}"


def oracle_sql() -> dict[str, str]:
    out = _oracles()
    if llm := _llm():
        out.update(llm[0].ORACLE_SQL)
        if llm[1].ORACLE_SQL:
            out["pipeline"] = llm[1].ORACLE_SQL
    return out
