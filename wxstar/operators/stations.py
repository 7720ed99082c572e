"""Station metadata: scope filter + typed coordinates, and the station reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxstar.functions.scalar import in_country, to_double
from wxstar.schemas import DEFAULT_COUNTRY


def transform_stations(stations: DataFrame, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """Keep the country's stations; latitude/longitude/elevation text -> double."""
    return stations.filter(in_country(country)).withColumns(
        {c: to_double(c) for c in ("latitude", "longitude", "elevation")}
    )


def stations_by_province(stations: DataFrame) -> DataFrame:
    """Station count per province code, largest first (ties by code)."""
    return (
        stations.groupBy("state")
        .agg(F.count("*").alias("stations"))
        .orderBy(F.desc("stations"), F.asc_nulls_first("state"))
    )


def station_counts(stations: DataFrame) -> DataFrame:
    """Stations in scope and how many lack a WMO id, in one pass."""
    return stations.agg(
        F.count("*").alias("stations"),
        F.count_if(F.col("wmo_id").isNull()).alias("wmo_null"),
    )
