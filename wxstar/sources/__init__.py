"""Readers: headerless observation CSV, fixed-width text, partitioned Parquet, and the
adapters that derive observation-shaped inputs from the driver's TPC-H-style tables."""

from wxstar.sources.fixed_width import parse_fixed_width, read_fixed_width  # noqa: F401
from wxstar.sources.files import (  # noqa: F401
    read_observations,
    read_quarantine,
    read_station_days,
    read_stations_parquet,
    read_yearly_extract,
    with_source_order,
    year_paths,
)
