"""Schemas, fixed-width layouts and the element tables that drive the pipeline."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# These must equal the source data's published format.
# ---------------------------------------------------------------------------

# Long observation rows (headerless CSV, one file per year). All columns are text on
# purpose, so malformed values surface as data instead of as nulls from a failed cast.
OBSERVATION_COLUMNS = [
    "id", "date", "element", "data_value", "m_flag", "q_flag", "s_flag", "obs_time",
]

# Fixed-width layouts: (name, first column, last column), 1-based and inclusive.
STATIONS_LAYOUT = [
    ("id", 1, 11),
    ("latitude", 13, 20),
    ("longitude", 22, 30),
    ("elevation", 32, 37),
    ("state", 39, 40),
    ("name", 42, 71),
    ("gsn_flag", 73, 75),
    ("hcn_crn_flag", 77, 79),
    ("wmo_id", 81, 85),
]

INVENTORY_LAYOUT = [
    ("id", 1, 11),
    ("latitude", 13, 20),
    ("longitude", 22, 30),
    ("element", 32, 35),
    ("first_year", 37, 40),
    ("last_year", 42, 45),
]

# Scope defaults: the country prefix of the station id and the six modelled elements.
DEFAULT_COUNTRY = "CA"
CORE_ELEMENTS = ["TMAX", "TMIN", "PRCP", "TAVG", "SNOW", "SNWD"]

# Elements published in tenths; every other element keeps its integer unit (snow in mm).
SCALE = {"TMAX": 10, "TMIN": 10, "PRCP": 10, "TAVG": 10}

# Missing-value sentinel of the fixed-width daily format.
MISSING_SENTINEL = "-9999"

# Season of a month number: 3-5 spring, 6-8 summer, 9-11 fall, anything else winter.
SEASONS = ["winter", "spring", "summer", "fall"]

# Default year ranges of the reports.
BACKFILL_FIRST_YEAR = 1990
BACKFILL_LAST_YEAR = 2025
SPAN_STARTS = (1990, 2000, 2010)
INCOMPLETE_FROM = 2024

# ---------------------------------------------------------------------------

OBSERVATION_SCHEMA = StructType(
    [StructField(c, StringType(), c in ("data_value", "m_flag", "q_flag", "s_flag", "obs_time"))
     for c in OBSERVATION_COLUMNS]
)

# Wide station-day rows as written to Parquet (year and month are partition columns;
# month is read back as text so that it keeps its two-digit form).
STATION_DAY_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("date", DateType()),
        StructField("tmax", DoubleType()),
        StructField("tmin", DoubleType()),
        StructField("prcp", DoubleType()),
        StructField("tavg", DoubleType()),
        StructField("snow", IntegerType()),
        StructField("snwd", IntegerType()),
        StructField("year", IntegerType()),
        StructField("month", StringType()),
    ]
)

# Quarantined long rows as written (year and month are partition columns).
QUARANTINE_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("date", DateType()),
        StructField("element", StringType()),
        StructField("data_value", IntegerType()),
        StructField("m_flag", StringType()),
        StructField("q_flag", StringType()),
        StructField("s_flag", StringType()),
        StructField("obs_time", StringType()),
        StructField("reason", StringType()),
        StructField("year", IntegerType()),
        StructField("month", StringType()),
    ]
)

# Warehouse table definitions (raw layer).
RAW_STATIONS_SCHEMA = StructType(
    [
        StructField("id", StringType(), False),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("elevation", DoubleType()),
        StructField("state", StringType()),
        StructField("name", StringType()),
        StructField("gsn_flag", StringType()),
        StructField("hcn_crn_flag", StringType()),
        StructField("wmo_id", StringType()),
    ]
)

RAW_OBSERVATIONS_SCHEMA = StructType(
    [
        StructField("id", StringType(), False),
        StructField("date", DateType(), False),
        StructField("tmax", DoubleType()),
        StructField("tmin", DoubleType()),
        StructField("prcp", DoubleType()),
        StructField("tavg", DoubleType()),
        StructField("snow", IntegerType()),
        StructField("snwd", IntegerType()),
    ]
)

# Headed yearly-mart extract (CSV).
YEARLY_EXTRACT_SCHEMA = StructType(
    [
        StructField("observation_year", IntegerType()),
        StructField("station_count", LongType()),
        StructField("avg_tmax_c", DoubleType()),
    ]
)


def element_column(element: str) -> str:
    """Wide column name of an element code (TMAX -> tmax)."""
    return element.lower()
