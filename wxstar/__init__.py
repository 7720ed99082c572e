"""wxstar: daily station-observation analytics as plain PySpark DataFrame functions.

Every public function takes and returns DataFrames (or writes them); the SparkSession
belongs to the caller, and nothing is collected to the driver inside the library.

Typical flow::

    from wxstar import read_observations, ingest, build_stations, build_star_schema
    raw = read_observations(spark, year_paths(src, [2024]), with_position=True)
    clean_path, quarantine_path = ingest(raw, out_root, years=[2024])
"""

from wxstar.operators.models import mart_yearly_climate, star_climate_by_province_season, with_tmax_share
from wxstar.operators.observations import (
    element_units,
    prepare_observations,
    split_by_quality,
    station_days_from_raw,
    to_station_days,
    transform_observations,
)
from wxstar.operators.validation import run_data_tests
from wxstar.plans.jobs import backfill, build_star_schema, build_stations, ingest, ingest_year, rolling_refresh
from wxstar.sources.files import read_observations, read_quarantine, read_station_days, year_paths
from wxstar.sources.fixed_width import parse_fixed_width, read_fixed_width
from wxstar.streaming.incremental import start_incremental_ingest

__version__ = "0.1.0"

__all__ = [
    "backfill", "build_star_schema", "build_stations", "element_units", "ingest", "ingest_year",
    "mart_yearly_climate", "parse_fixed_width", "prepare_observations", "read_fixed_width",
    "read_observations", "read_quarantine", "read_station_days", "rolling_refresh", "run_data_tests",
    "split_by_quality", "star_climate_by_province_season", "start_incremental_ingest",
    "station_days_from_raw", "to_station_days", "transform_observations", "with_tmax_share", "year_paths",
]
