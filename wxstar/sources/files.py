"""File readers with fixed schemas (never inferred)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxstar.functions.scalar import year_from_path, year_in_path
from wxstar.schemas import (
    OBSERVATION_SCHEMA,
    QUARANTINE_SCHEMA,
    RAW_STATIONS_SCHEMA,
    STATION_DAY_SCHEMA,
    YEARLY_EXTRACT_SCHEMA,
)

# Up to this many input files, their list (a path and a rank each) is broadcast.
MAX_BROADCAST_FILES = 100_000


#: Suffix of a year's files, whether it is one file or several parts (``1998.csv.gz``; ``1998-00000.csv.gz``, ...).
YEAR_PARTS = "[.-]*gz"


def year_paths(prefix: str, years: Iterable[int], suffix: str = ".csv.gz") -> list[str]:
    """``{prefix}/{year}.csv.gz`` for every year: the by-year layout of the source. With ``YEAR_PARTS`` as suffix a year may
    also be several parts, in the order of their names."""
    return [f"{prefix.rstrip('/')}/{y}{suffix}" for y in years]


def read_observations(
    spark: SparkSession, paths: str | list[str], with_file_year: bool = False, with_position: bool = False
) -> DataFrame:
    """Headerless observation CSV (gzip or plain) with the fixed all-text schema.

    One scan covers any number of yearly files; a ``.gz`` file is not splittable, so each
    is one task and parallelism comes from the number of files. ``with_file_year`` adds
    ``file_year`` taken from the file name (the task fails on a name without a year).
    ``with_position`` adds ``src_file`` and ``src_block`` (file and split start), the
    deterministic part of a row's position; see :func:`with_source_order`.
    Empty fields, bare or quoted, read as null.
    """
    df = spark.read.csv(paths, schema=OBSERVATION_SCHEMA, header=False, mode="PERMISSIVE")
    if with_file_year:
        df = df.withColumn("file_year", year_from_path(F.col("_metadata.file_path")))
    if with_position:
        df = df.withColumns({
            "src_file": F.col("_metadata.file_path"),
            "src_block": F.col("_metadata.file_block_start"),
        })
    return df


def with_source_year(df: DataFrame) -> DataFrame:
    """``source_year``: the year in a row's file name (null if none), the fallback year of
    rows whose date text has no usable year, so a year replace never loses them."""
    return df.withColumn("source_year", year_in_path(F.col("_metadata.file_path")))


def with_source_order(df: DataFrame, name: str = "src_order") -> DataFrame:
    """Row position in the source as one number that orders rows by (file name, exact split
    start, row within the split), however Spark packs splits into tasks.

    The three parts are digits of one ``decimal(38)``: the file's rank in the sorted list of
    input files, the split's start byte, the row's index within its task (within one split it
    grows in file order). A decimal keeps the pivot a hash aggregate; a struct or text key
    would force a sort-based one. The ranks are joined on after the row index is taken; their
    number is that of the input files, which the driver lists in any scan, and beyond
    ``MAX_BROADCAST_FILES`` the join is a merge join. Apply after filters: the row index is
    non-deterministic for the optimizer and would stop their push-down; a recomputed partition
    re-reads the same split and gets the same indexes.
    """
    # both sides name a file alike but for the slashes after the scheme
    files = sorted({re.sub(r"^(\w[\w+.-]*):/+", r"\1:/", f) for f in df.inputFiles()})
    at = F.regexp_replace("src_file", r"^(\w[\w+.-]*):/+", "$1:/")
    ranks = df.sparkSession.range(1).select(
        F.posexplode(F.lit(files).cast("array<string>")).alias("__rank", "__file")
    ).hint("broadcast" if len(files) <= MAX_BROADCAST_FILES else "merge")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # a row without a rank would silently lose its cells
    rank = F.coalesce("__rank", F.raise_error(F.concat(F.lit("not among the input files: "), at)).cast("int"))
    digits = lambda c, n: c.cast(f"decimal({n},0)")
    split = digits(rank, 9) * digits(F.lit(10**15), 16) + digits(F.col("src_block"), 15)
    key = split.cast("decimal(26,0)") * digits(F.lit(10**10), 11) + digits(F.col("__row"), 10)
    return (
        df.withColumn("__row", row)
        .join(ranks, at == F.col("__file"), "left")
        .withColumn(name, key.cast("decimal(38,0)"))
        .drop("src_file", "src_block", "__row", "__rank", "__file")
    )


def read_station_days(spark: SparkSession, path: str) -> DataFrame:
    """Partitioned station-day Parquet (``year=/month=``) with an explicit schema, so
    ``month`` stays the two-digit text it was written as instead of being inferred as int."""
    return spark.read.schema(STATION_DAY_SCHEMA).parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Quarantined rows with their fixed schema (an empty quarantine reads as no rows)."""
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(path)


def read_stations_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_STATIONS_SCHEMA).parquet(path)


def read_yearly_extract(spark: SparkSession, path: str) -> DataFrame:
    """Headed yearly-mart CSV: rows without a mean TMAX dropped, ordered by year."""
    return (
        spark.read.csv(path, header=True, schema=YEARLY_EXTRACT_SCHEMA)
        .filter(F.col("avg_tmax_c").isNotNull())
        .orderBy("observation_year")
    )
