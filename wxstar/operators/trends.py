"""Year-level trends over station-days and the yearly mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxstar.schemas import INCOMPLETE_FROM


def yearly_counts(station_days: DataFrame, year_col: str = "year") -> DataFrame:
    """Station-days per year (only the year column is read: ``ReadSchema`` is empty or
    ``year`` alone, and a partitioned input answers from the partition values)."""
    return station_days.groupBy(F.col(year_col).alias("year")).agg(F.count("*").alias("count")).orderBy("year")


def with_yoy_change(yearly: DataFrame, count_col: str = "count", year_col: str = "year") -> DataFrame:
    """Previous year's count (``lag``) and the change in % (2 decimals, null in the first
    year). The window has no partition key, which is fine: its input is one row per
    year, already aggregated, never raw rows."""
    count, before = F.col(count_col), F.lag(count_col).over(Window.orderBy(year_col))
    return yearly.select(
        "*", before.alias("previous_year_count"), F.round(F.try_divide(count - before, before) * 100, 2).alias("change_pct"))


def monthly_counts(station_days: DataFrame, year: int, non_null: str | None = None) -> DataFrame:
    """Station-days per month of one year; with ``non_null``, only days where that column
    has a value. The year equality is on the partition column, so a partitioned input
    reads only that year's directories."""
    df = station_days.filter(F.col("year") == year)
    if non_null:
        df = df.filter(F.col(non_null).isNotNull())
    return df.groupBy("month").agg(F.count("*").alias("count")).orderBy("month")


def incomplete_flag(mart: DataFrame, incomplete_from: int = INCOMPLETE_FROM) -> DataFrame:
    """Report column marking years that must not carry a trend; never stored in the mart."""
    return mart.withColumn("incomplete", F.col("observation_year") >= F.lit(incomplete_from))


def low_year(mart: DataFrame, value: str = "avg_tmax_c", year_col: str = "observation_year") -> DataFrame:
    """Year of the lowest value (ties: earliest year), as one row; years without a value
    are skipped."""
    best = mart.filter(F.col(value).isNotNull()).agg(
        F.min(F.struct(F.col(value).alias("v"), F.col(year_col).alias("y"))).alias("m")
    )
    # a global aggregate always yields one row; no year with a value means no row at all
    return best.filter(F.col("m").isNotNull()).select(F.col("m.y").alias(year_col), F.col("m.v").alias(value))


def first_last_complete(
    mart: DataFrame, incomplete_from: int = INCOMPLETE_FROM, year_col: str = "observation_year",
    value: str = "station_count",
) -> DataFrame:
    """The first year's station count and that of the last complete year
    (``incomplete_from - 1``), the two figures a report labels."""
    last = incomplete_from - 1
    return mart.agg(
        F.min(year_col).alias("first_year"),
        F.min_by(F.col(value), F.col(year_col)).alias("first_station_count"),
        F.lit(last).alias("last_complete_year"),
        F.max(F.when(F.col(year_col) == last, F.col(value))).alias("last_complete_station_count"),
    )
