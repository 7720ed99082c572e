"""Write jobs: one-year ingest, multi-year backfill, rolling refresh, station dimension,
star-schema build. Each is a short sequence of Spark writes; no data passes through the
driver. The session belongs to the caller."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxstar.operators import models, validation
from wxstar.operators.observations import prepare_observations, split_by_quality, transform_observations
from wxstar.operators.stations import transform_stations
from wxstar.schemas import (
    CORE_ELEMENTS,
    DEFAULT_COUNTRY,
    QUARANTINE_SCHEMA,
    RAW_OBSERVATIONS_SCHEMA,
    RAW_STATIONS_SCHEMA,
    STATIONS_LAYOUT,
)
from wxstar.sinks.catalog import create_namespace, new_version, staging_view
from wxstar.sinks.parquet import (
    conform,
    load_together,
    materialize,
    replace_undated,
    replace_years,
    table_name,
    undated_name,
    write_bucketed_fact,
    write_partitioned,
    write_stations,
)
from wxstar.sources.files import (
    YEAR_PARTS,
    read_observations,
    read_quarantine,
    read_station_days,
    read_stations_parquet,
    with_source_order,
    with_source_year,
    year_paths,
)
from wxstar.sources.fixed_width import read_fixed_width


def _outputs(root: str) -> tuple[str, str]:
    root = root.rstrip("/")
    return f"{root}/processed/observations.parquet", f"{root}/quarantined/observations.parquet"


def undated_path(out_root: str) -> str:
    """Quarantined rows that have no year at all (see ``sinks.replace_undated``)."""
    return f"{out_root.rstrip('/')}/quarantined/undated.parquet"


def ingest(
    raw: DataFrame, out_root: str, years: Iterable[int] | str | None = None, order_key: str | None = None,
    country: str = DEFAULT_COUNTRY, elements: list[str] = CORE_ELEMENTS, undated_key: str | None = None,
) -> tuple[str, str]:
    """scan -> prepare -> split -> quarantine write -> pivot -> clean write.

    With ``years`` each listed year directory is replaced whole (a rerun of a year is
    idempotent, a vanished month disappears); ``years="from_data"`` replaces the years of
    :func:`touched_years`; without, both outputs are written fresh in one job each.
    In the replacing modes no row of the scope is dropped: a good row of another year is
    quarantined as ``out_of_window``, a rejected row whose date text names another year stays
    with its file's year, and what then has no year of the run goes to :func:`undated_path`
    (a fresh write keeps rows without a year in the default partition).

    The prepared scope (already ~14x smaller than the raw scan) is persisted because both
    writes read it; on executor loss its blocks are recomputed from the source files.
    When the input carries source positions (``read_observations(with_position=True)``)
    and no ``order_key`` is given, repeated cells resolve to the first row in file order.
    """
    clean_path, quarantine_path = _outputs(out_root)
    file_year = F.col("source_year") if "source_year" in raw.columns else F.lit(None).cast("int")
    prepared = prepare_observations(raw.withColumn("__file_year", file_year), country, elements)
    if order_key is None and "src_file" in prepared.columns:
        prepared, order_key = with_source_order(prepared), "src_order"  # first row in file order
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        clean, rejected = split_by_quality(prepared)
        if years is None:
            write_partitioned(rejected.drop("__file_year"), quarantine_path)
            write_partitioned(transform_observations(clean.drop("__file_year"), order_key, elements), clean_path)
        else:
            years = touched_years(prepared) if years == "from_data" else sorted(set(years))
            clean, rejected = within(clean, rejected, years)
            replace_years(rejected, quarantine_path, years)
            replace_undated(rejected, undated_path(out_root), years, undated_key)
            replace_years(transform_observations(clean, order_key, elements), clean_path, years)
    finally:
        prepared.unpersist()
    return clean_path, quarantine_path


def within(clean: DataFrame, rejected: DataFrame, years: list[int]) -> tuple[DataFrame, DataFrame]:
    """The clean rows of ``years``, and all that a run over these years rejects: good rows of other years too, as
    ``out_of_window``; a row whose date names none of them is of its file's year, or else of none."""
    inside = F.coalesce(F.col("year").isin(years), F.lit(False))
    outside = clean.filter(~inside).withColumn("reason", F.lit("out_of_window"))
    in_file = F.when(F.col("__file_year").isin(years), F.col("__file_year"))
    rejected = rejected.unionByName(outside).withColumn("year", F.when(inside, F.col("year")).otherwise(in_file))
    return clean.filter(inside).drop("__file_year"), rejected.drop("__file_year")


def touched_years(prepared: DataFrame) -> list[int]:
    """The years of valid dates and, for rows without one, of their files: at most one value per
    calendar year, however dirty the date text is."""
    year = F.coalesce(F.year("date"), F.col("__file_year"))
    return sorted(r[0] for r in prepared.select(year.alias("y")).distinct().collect() if r[0] is not None)


def ingest_year(spark: SparkSession, source_prefix: str, out_root: str, year: int) -> tuple[str, str]:
    """The one-year job: ``{source_prefix}/{year}.csv.gz`` (or its parts) -> that year's partitions."""
    raw = with_source_year(read_observations(spark, year_paths(source_prefix, [year], YEAR_PARTS), with_position=True))
    return ingest(raw, out_root, years=[year])


def backfill(spark: SparkSession, source_prefix: str, out_root: str, first: int, last: int) -> tuple[str, str]:
    """All years in one job: one scan over every yearly file (one task per ``.gz``; see ``lake.land`` for hot years), one
    shuffle for the pivot. Replaces exactly the years ``first`` to ``last``; others stay."""
    raw = with_source_year(
        read_observations(spark, year_paths(source_prefix, range(first, last + 1), YEAR_PARTS), with_position=True))
    return ingest(raw, out_root, years=range(first, last + 1))


def refresh_window(as_of: _dt.datetime | _dt.date, years: int = 2) -> list[int]:
    """[Y-1, Y] for the year of the run time (``years`` wide)."""
    return list(range(as_of.year - years + 1, as_of.year + 1))


def rolling_refresh(
    spark: SparkSession, source_prefix: str, out_root: str, as_of: _dt.datetime | _dt.date, years: int = 2
) -> tuple[str, str]:
    """Daily refresh: re-ingest the last ``years`` years and replace exactly those."""
    window = refresh_window(as_of, years)
    raw = with_source_year(read_observations(spark, year_paths(source_prefix, window, YEAR_PARTS), with_position=True))
    return ingest(raw, out_root, years=window)


def run_metrics(
    spark: SparkSession, clean_path: str, quarantine_path: str, years: Iterable[int] | None = None
) -> DataFrame:
    """Station-days written and rows quarantined, from the written files (a Parquet count
    is answered from file metadata, no re-computation of the pipeline).

    With the ``years`` that a run replaced, that run alone is counted, since it wrote these
    year folders whole: its station-days, its rejected rows by reason, and its rows without
    any year.
    """
    sd, rj = read_station_days(spark, clean_path), read_quarantine(spark, quarantine_path)
    total = lambda df, name: df.agg(F.lit(name).alias("metric"), F.count("*").alias("rows"))
    if years is None:
        return total(sd, "station_days").unionByName(total(rj, "rejected"))
    years = sorted(set(years))
    undated = f"{quarantine_path.rstrip('/').rsplit('/', 1)[0]}/undated.parquet/years={undated_name(years)}"
    reasons = rj.filter(F.col("year").isin(years)).groupBy("reason").agg(F.count("*").alias("rows"))
    return (
        total(sd.filter(F.col("year").isin(years)), "station_days")
        .unionByName(reasons.select(F.concat(F.lit("rejected_"), "reason").alias("metric"), "rows"))
        .unionByName(total(spark.read.schema(QUARANTINE_SCHEMA).parquet(undated), "undated"))
    )


def build_stations(
    spark: SparkSession, source_path: str, out_path: str, country: str = DEFAULT_COUNTRY
) -> DataFrame:
    """Fixed-width station file -> the country's typed stations -> Parquet (full
    overwrite). Returns the written table read back."""
    stations = transform_stations(read_fixed_width(spark, source_path, STATIONS_LAYOUT), country)
    write_stations(conform(stations, RAW_STATIONS_SCHEMA), out_path)
    return read_stations_parquet(spark, out_path)


def load_raw_tables(
    spark: SparkSession, observations_path: str, stations_path: str, root: str
) -> dict[str, DataFrame]:
    """Both raw tables from the lake, switched together only when each holds as many rows as
    its source (the counts come from Parquet footers)."""
    obs, stations = read_station_days(spark, observations_path), read_stations_parquet(spark, stations_path)
    return load_together(spark, {
        "raw_observations": (obs, RAW_OBSERVATIONS_SCHEMA, obs.count()),
        "raw_stations": (stations, RAW_STATIONS_SCHEMA, stations.count()),
    }, root)


def build_star_schema(
    spark: SparkSession, observations_path: str, stations_path: str, out_root: str, target: str = "dev",
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """both raw tables loaded together -> staging (views) -> dimensions, fact, mart (tables) + the test suite.

    All are entries of the namespaces that ``target`` names, seen by every session; a table is switched
    to its new version only after it is written. With ``buckets`` the fact is stored bucketed by station and sorted by date, so station-keyed
    work on it, such as the mart's distinct station count, skips the exchange on the station key.
    Returns the materialised models by name, plus ``data_tests``.
    """
    stg, mart_ns, raw_ns = (create_namespace(spark, table_name(layer, target)) for layer in ("staging", "marts", "raw"))
    root = out_root.rstrip("/")
    raw = load_raw_tables(spark, observations_path, stations_path, f"{root}/{raw_ns}")
    raw_obs, raw_st = raw["raw_observations"], raw["raw_stations"]
    for name, df in raw.items():  # the versions just switched, by name for every session
        spark.sql(f"CREATE OR REPLACE VIEW `{raw_ns}`.`{name}` AS SELECT * FROM parquet.`{df.inputFiles()[0].rsplit('/', 1)[0]}`")
    stg_obs = staging_view(spark, f"{stg}.stg_observations", f"{raw_ns}.raw_observations", models.OBSERVATION_RENAMES)
    stg_st = staging_view(spark, f"{stg}.stg_stations", f"{raw_ns}.raw_stations", models.STATION_RENAMES)
    fct_name = f"{mart_ns}.fct_daily_weather"
    if buckets:
        write_bucketed_fact(models.fct_daily_weather(stg_obs), fct_name, buckets, path=f"{new_version(f'{root}/{mart_ns}')}/fct_daily_weather")
        fct = spark.table(fct_name)
    else:
        fct = materialize(spark, models.fct_daily_weather(stg_obs), fct_name, "table", f"{root}/{mart_ns}")
    dim_st = materialize(spark, models.dim_station(stg_st), f"{mart_ns}.dim_station", "table", f"{root}/{mart_ns}")
    dim_dt = materialize(spark, models.dim_date(fct), f"{mart_ns}.dim_date", "table", f"{root}/{mart_ns}")
    mart = materialize(spark, models.mart_yearly_climate(fct), f"{mart_ns}.mart_yearly_climate", "table", f"{root}/{mart_ns}")
    tests = validation.run_data_tests(raw_st, raw_obs, dim_dt, dim_st, fct, mart)
    return {
        "raw_stations": raw_st, "raw_observations": raw_obs, "stg_observations": stg_obs,
        "stg_stations": stg_st, "fct_daily_weather": fct, "dim_station": dim_st, "dim_date": dim_dt,
        "mart_yearly_climate": mart, "data_tests": tests,
    }
