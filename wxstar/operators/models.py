"""Star schema over station-days: staging renames, dimensions, fact, yearly mart, star query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxstar.functions.scalar import season_of

# Staging renames (fixed values: the published column names). Units live in the names from here on.
OBSERVATION_RENAMES = {
    "id": "station_id",
    "date": "observation_date",
    "tmax": "tmax_c",
    "tmin": "tmin_c",
    "tavg": "tavg_c",
    "prcp": "prcp_mm",
    "snow": "snow_fall_mm",
    "snwd": "snwd_depth_mm",
}
STATION_RENAMES = {
    "id": "station_id",
    "latitude": "latitude",
    "longitude": "longitude",
    "elevation": "elevation_m",
    "state": "province",
    "name": "station_name",
    "gsn_flag": "gsn_flag",
    "hcn_crn_flag": "hcn_crn_flag",
    "wmo_id": "wmo_id",
}


def _rename(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(src).alias(dst) for src, dst in renames.items()])


def stg_observations(raw_observations: DataFrame) -> DataFrame:
    return _rename(raw_observations, OBSERVATION_RENAMES)


def stg_stations(raw_stations: DataFrame) -> DataFrame:
    return _rename(raw_stations, STATION_RENAMES)


def fct_daily_weather(stg_obs: DataFrame) -> DataFrame:
    """Identity model over the staged observations (grain: station, date)."""
    return stg_obs


def dim_station(stg_st: DataFrame) -> DataFrame:
    """Identity model: every station, deliberately not pruned to those with facts."""
    return stg_st


def date_attributes(date_col: str = "date_day") -> dict:
    d = F.col(date_col)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "season": season_of(F.month(d)),
    }


def dim_date(stg_obs: DataFrame) -> DataFrame:
    """Distinct observed dates with year/month/day (int) and season. Derived, not
    generated: a day without any observation is absent (see ``calendar_gaps``)."""
    days = stg_obs.select(F.col("observation_date").alias("date_day")).distinct()
    return days.withColumns(date_attributes("date_day"))


# Fact measures averaged by the mart: (column, stored precision as units per 1, output name).
MART_MEASURES = [
    ("tmax_c", 10, "avg_tmax_c"),
    ("tmin_c", 10, "avg_tmin_c"),
    ("tavg_c", 10, "avg_tavg_c"),
    ("prcp_mm", 10, "avg_prcp_mm"),
    ("snow_fall_mm", 1, "avg_snow_mm"),
    ("snwd_depth_mm", 1, "avg_snwd_mm"),
]


def tenths(column: str):
    """Sum of values stored in tenths, as a whole number of tenths: exact in any order of summation."""
    return F.sum(F.round(F.col(column) * 10).cast("bigint"))


def exact_mean(column: str, units: int, digits: int):
    """Mean of values stored at a precision of ``1/units`` (tenths: 10), computed from
    their exact integer sum and rounded half away from zero to ``digits`` decimals; null
    without values. Unlike a floating-point ``avg``, the result does not depend on the
    order in which partitions are summed, so reruns are identical bit for bit."""
    if (10 ** digits) % units:
        raise ValueError("units must divide 10**digits")
    total = F.sum(F.round(F.col(column) * units).cast("long"))
    n = F.count(column)
    a = F.abs(total) * (2 * 10 ** digits // units) + n
    b = n * 2
    q = F.call_function("div", a, b)  # integer division: exact beyond 2^53
    return F.when(n > 0, F.signum(total) * q / F.lit(float(10 ** digits)))


def mart_yearly_climate(fct: DataFrame, exact_digits: int | None = None) -> DataFrame:
    """One row per year. ``station_count`` = distinct stations; ``tmax_days`` counts only
    non-null TMAX; averages skip nulls. Spark plans the distinct count as partial
    aggregation on (year, station) and then on year, so no raw row crosses the network
    twice and a hot station is collapsed map-side.

    With ``exact_digits`` the averages are :func:`exact_mean` values (deterministic,
    rounded half-up to that many decimals) instead of floating-point ``avg``.
    """
    means = [
        (F.avg(c) if exact_digits is None else exact_mean(c, u, exact_digits)).alias(name)
        for c, u, name in MART_MEASURES
    ]
    return fct.groupBy(F.year("observation_date").alias("observation_year")).agg(
        F.countDistinct("station_id").alias("station_count"),
        F.count("tmax_c").alias("tmax_days"),
        F.count("station_id").alias("station_days"),
        *means,
    )


def with_tmax_share(mart: DataFrame, digits: int = 3) -> DataFrame:
    """``tmax_share = tmax_days / station_days`` rounded; null (not an error) for 0 days."""
    return mart.withColumn(
        "tmax_share", F.round(F.try_divide(F.col("tmax_days"), F.col("station_days")), digits)
    )


def star_climate_by_province_season(
    fct: DataFrame, dim_st: DataFrame, dim_dt: DataFrame
) -> DataFrame:
    """Fact joined to both dimensions, summarised by province and season.

    ``dim_date`` holds at most one row per calendar day, so broadcasting it is safe at any
    fact size. The fact is then pre-aggregated to (station, season) before it meets
    ``dim_station``, so that join sees a few rows per station whatever the fact size and
    Spark may broadcast or shuffle the station side as its statistics dictate; with both tables bucketed
    by station (``sinks.write_bucketed``) neither is exchanged. Sums are taken in whole tenths.
    """
    per_station = (
        fct.join(F.broadcast(dim_dt.select("date_day", "season")),
                 fct.observation_date == F.col("date_day"))
        .groupBy("station_id", "season")
        .agg(
            F.count("*").alias("n"),
            tenths("tmax_c").alias("s_tmax"),
            F.count("tmax_c").alias("n_tmax"),
            tenths("prcp_mm").alias("s_prcp"),
            F.count("prcp_mm").alias("n_prcp"),
        )
    )
    return (
        per_station.join(dim_st.select("station_id", "province"), "station_id")
        .groupBy("province", "season")
        .agg(
            F.countDistinct("station_id").alias("stations"),
            F.sum("n").alias("station_days"),
            F.sum("n_tmax").alias("tmax_days"),
            (F.sum("s_tmax") / 10).alias("sum_tmax_c"),
            F.sum("n_prcp").alias("prcp_days"),
            (F.sum("s_prcp") / 10).alias("sum_prcp_mm"),
        )
        .withColumns({
            "avg_tmax_c": F.try_divide(F.col("sum_tmax_c"), F.col("tmax_days")),
            "avg_prcp_mm": F.try_divide(F.col("sum_prcp_mm"), F.col("prcp_days")),
        })
    )
