"""The lake as catalog tables: ingest by year with metrics of the run, and a mart kept by changed years.

Tables of a namespace, each partitioned and switched by year (see ``sinks.catalog``): ``station_days``,
``quarantine``, ``mart_yearly_climate``; ``undated`` (rejected rows without any year, by the run's years) and
``run_metrics`` (by run).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from wxstar.operators import models
from wxstar.operators.observations import prepare_observations, split_by_quality, transform_observations
from wxstar.plans.jobs import within
from wxstar.schemas import CORE_ELEMENTS, DEFAULT_COUNTRY, OBSERVATION_SCHEMA, QUARANTINE_SCHEMA, STATION_DAY_SCHEMA
from wxstar.sinks import catalog
from wxstar.sinks.parquet import undated_name
from wxstar.sources.files import YEAR_PARTS, read_observations, with_source_order, with_source_year, year_paths

MART_SCHEMA = StructType(
    [StructField("observation_year", IntegerType()), StructField("station_count", LongType()), StructField("tmax_days", LongType()),
     StructField("station_days", LongType())] + [StructField(name, DoubleType()) for _, _, name in models.MART_MEASURES])
UNDATED_SCHEMA = StructType([f for f in QUARANTINE_SCHEMA.fields if f.name not in ("year", "month")] + [StructField("run_years", StringType())])
METRICS_SCHEMA = StructType([StructField("metric", StringType()), StructField("rows", LongType()), StructField("run", StringType())])
LANDED_SCHEMA = StructType([*OBSERVATION_SCHEMA.fields, StructField("src_order", DecimalType(38, 0)), StructField("source_year", IntegerType())])
ROWS_PER_FILE = 4_000_000
REASONS = ("q_flag", "bad_date", "out_of_window")


def open_lake(spark: SparkSession, namespace: str, root: str) -> None:
    """Creates the namespace's tables where they are missing."""
    catalog.create_namespace(spark, namespace)
    for table, schema, by in (("station_days", STATION_DAY_SCHEMA, "year"), ("quarantine", QUARANTINE_SCHEMA, "year"),
                              ("mart_yearly_climate", MART_SCHEMA, "observation_year"), ("undated", UNDATED_SCHEMA, "run_years"),
                              ("run_metrics", METRICS_SCHEMA, "run")):
        catalog.year_table(spark, f"{namespace}.{table}", schema, root, by)


def ingest_years(
    raw: DataFrame, namespace: str, root: str, years: Iterable[int], order_key: str | None = None,
    country: str = DEFAULT_COUNTRY, elements: list[str] = CORE_ELEMENTS,
) -> str:
    """Replaces ``years`` of the lake by the scope's rows in ``raw``; no row of the scope is dropped (``jobs.within``).

    Every table is written before any year is switched; a year's clean and rejected rows are switched together.
    The run's metrics (station-days, rejected rows by reason, rows without a year) are observed in the
    write jobs themselves, so no output is read again, and kept in ``run_metrics`` under the run's name, which is returned.
    """
    spark, years = raw.sparkSession, sorted(set(years))
    open_lake(spark, namespace, root)
    version = catalog.new_version(root)
    run, run_years = version.rsplit("/", 1)[1], undated_name(years)
    file_year = F.col("source_year") if "source_year" in raw.columns else F.lit(None).cast("int")
    prepared = prepare_observations(raw.withColumn("__file_year", file_year), country, elements)
    if order_key is None and "src_file" in prepared.columns:
        prepared, order_key = with_source_order(prepared), "src_order"
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        clean, rejected = within(*split_by_quality(prepared), years)
        rejected = rejected.select(*QUARANTINE_SCHEMA.fieldNames())
        seen = {name: Observation(f"{name}-{run}") for name in ("station_days", "quarantine", "undated")}
        days = transform_observations(clean, order_key, elements).select(*STATION_DAY_SCHEMA.fieldNames())
        catalog.write_partitions(
            days.observe(seen["station_days"], F.count(F.lit(1)).alias("n")), f"{version}/station_days", cluster=("month",))
        catalog.write_partitions(
            rejected.filter(F.col("year").isNotNull()).observe(
                seen["quarantine"], *(F.count_if(F.col("reason") == r).alias(r) for r in REASONS)),
            f"{version}/quarantine", cluster=("month",))
        undated = rejected.filter(F.col("year").isNull()).drop("year", "month").withColumn("run_years", F.lit(run_years))
        catalog.write_partitions(undated.observe(seen["undated"], F.count(F.lit(1)).alias("n")), f"{version}/undated", "run_years")
    finally:
        prepared.unpersist()
    counted = {name: catalog.observed(o) for name, o in seen.items()}
    rows = [("station_days", counted["station_days"].get("n", 0))]
    rows += [(f"rejected_{r}", n) for r, n in counted["quarantine"].items() if n]
    rows += [("undated", counted["undated"].get("n", 0))]
    metrics = spark.createDataFrame([(m, n, run) for m, n in rows], METRICS_SCHEMA)
    catalog.write_partitions(metrics, f"{version}/run_metrics", "run")
    for year in years:
        for table in ("station_days", "quarantine"):
            catalog.switch(spark, f"{namespace}.{table}", year, f"{version}/{table}")
    catalog.switch(spark, f"{namespace}.undated", run_years, f"{version}/undated", "run_years")
    catalog.switch(spark, f"{namespace}.run_metrics", run, f"{version}/run_metrics", "run")
    return run


def land(spark: SparkSession, source_prefix: str, namespace: str, root: str, years: Iterable[int], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Re-lays the yearly source files into ``landed``, by source year: Parquet files of at most ``rows_per_file`` rows with
    every row's place in the source. A gzip file is read by one task, once and for nothing else; whatever reads a landed
    year, however hot, does so in many tasks, and repeated cells still resolve in file order."""
    years = sorted(set(years))
    catalog.create_namespace(spark, namespace)
    catalog.year_table(spark, f"{namespace}.landed", LANDED_SCHEMA, root, "source_year")
    raw = with_source_order(with_source_year(read_observations(spark, year_paths(source_prefix, years, YEAR_PARTS), with_position=True)))
    version = catalog.new_version(root)
    # each task writes its rows in order, cutting a file where it is full
    raw.select(*LANDED_SCHEMA.fieldNames()).write.option("maxRecordsPerFile", rows_per_file).partitionBy("source_year").parquet(f"{version}/landed")
    for year in years:
        catalog.switch(spark, f"{namespace}.landed", year, f"{version}/landed", "source_year")


def ingest_landed(spark: SparkSession, namespace: str, root: str, years: Iterable[int]) -> str:
    """:func:`ingest_years` from the landed files of ``years``."""
    years = sorted(set(years))
    return ingest_years(
        spark.table(f"{namespace}.landed").filter(F.col("source_year").isin(years)), namespace, root, years, order_key="src_order")


def refresh_mart(spark: SparkSession, namespace: str, root: str, years: Iterable[int]) -> None:
    """Recomputes ``years`` of the yearly mart from these years' station-days alone (the filter prunes the other
    partitions) and switches them; the files of other years stay. A year is a function of its own days, so the mart equals one
    built from everything."""
    years = sorted(set(years))
    days = spark.table(f"{namespace}.station_days").filter(F.col("year").isin(years))
    mart = models.mart_yearly_climate(models.fct_daily_weather(models.stg_observations(days)))
    catalog.replace_partitions(
        spark, {f"{namespace}.mart_yearly_climate": mart.select(*MART_SCHEMA.fieldNames())}, years, root, "observation_year")
