"""Raw observations + station text -> every layer of the star schema, as lazy plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from wxstar.operators import models
from wxstar.operators.observations import prepare_observations, split_by_quality, transform_observations
from wxstar.operators.stations import transform_stations
from wxstar.schemas import CORE_ELEMENTS, DEFAULT_COUNTRY, STATIONS_LAYOUT
from wxstar.sources.fixed_width import parse_fixed_width


@dataclass
class Star:
    raw_observations: DataFrame  # long, all text, every country and element
    prepared: DataFrame          # scope, typed
    clean: DataFrame
    rejected: DataFrame
    station_days: DataFrame      # wide, id/date/tmax.../year/month
    stations_text: DataFrame     # every station, parsed text fields
    stations: DataFrame          # the country's stations, typed (raw_stations)
    raw_obs_table: DataFrame     # raw_observations warehouse table
    fct: DataFrame
    dim_station: DataFrame
    dim_date: DataFrame
    mart: DataFrame


def build_star(
    raw_observations: DataFrame, station_lines: DataFrame, order_key: str | None = None,
    country: str = DEFAULT_COUNTRY, elements: list[str] = CORE_ELEMENTS,
) -> Star:
    prepared = prepare_observations(raw_observations, country, elements)
    clean, rejected = split_by_quality(prepared)
    station_days = transform_observations(clean, order_key, elements)
    stations_text = parse_fixed_width(station_lines, STATIONS_LAYOUT)
    stations = transform_stations(stations_text, country)
    raw_obs_table = station_days.select("id", "date", "tmax", "tmin", "prcp", "tavg", "snow", "snwd")
    fct = models.fct_daily_weather(models.stg_observations(raw_obs_table))
    dim_station = models.dim_station(models.stg_stations(stations))
    dim_date = models.dim_date(fct)
    mart = models.mart_yearly_climate(fct)
    return Star(
        raw_observations, prepared, clean, rejected, station_days, stations_text, stations,
        raw_obs_table, fct, dim_station, dim_date, mart,
    )


def star_from_tables(spark, sf_dir: str, country: str = DEFAULT_COUNTRY) -> Star:
    """The star schema over the adapters of the driver's tables (see ``sources.tables``)."""
    from wxstar.sources import tables

    return build_star(
        tables.long_observations(spark, sf_dir), tables.station_lines(spark, sf_dir),
        order_key="src_order", country=country,
    )
