"""Star-schema models and the counting traps (T13, T14, T17)."""

import datetime as dt

from wxstar.operators import models, profiling

D = dt.date


def _raw_obs(spark):
    return spark.createDataFrame(
        [("CA1", D(2024, 1, 1), 5.0, 1.0, None, 0.5, 10, 3),
         ("CA1", D(2024, 1, 2), None, 2.0, None, 0.0, None, 4),
         ("CA2", D(2024, 7, 1), 7.0, None, 20.0, None, 3, None),
         ("CA2", D(2023, 12, 31), 1.0, 0.0, None, 0.0, 0, 0)],
        "id string, date date, tmax double, tmin double, tavg double, prcp double, snow int, snwd int")


def test_staging_renames_carry_units(spark):
    fct = models.stg_observations(_raw_obs(spark))
    assert fct.columns == ["station_id", "observation_date", "tmax_c", "tmin_c", "tavg_c", "prcp_mm",
                           "snow_fall_mm", "snwd_depth_mm"]
    st = spark.createDataFrame([("CA1", 1.0, 2.0, 3.0, "ON", "A", None, None, None)],
                               "id string, latitude double, longitude double, elevation double, state string, "
                               "name string, gsn_flag string, hcn_crn_flag string, wmo_id string")
    assert models.stg_stations(st).columns == ["station_id", "latitude", "longitude", "elevation_m", "province",
                                               "station_name", "gsn_flag", "hcn_crn_flag", "wmo_id"]


def test_mart_counts_and_averages(spark):
    mart = {r.observation_year: r for r in models.mart_yearly_climate(models.stg_observations(_raw_obs(spark))).collect()}
    y = mart[2024]
    assert (y.station_count, y.station_days, y.tmax_days) == (2, 3, 2)  # T13: tmax_days counts non-null only
    assert y.avg_tmax_c == 6.0 and y.avg_tavg_c == 20.0                  # nulls skipped
    assert isinstance(y.avg_snow_mm, float) and y.avg_snow_mm == 6.5     # T14: avg of int is double
    assert models.with_tmax_share(models.mart_yearly_climate(models.stg_observations(_raw_obs(spark)))) \
        .filter("observation_year = 2024").first().tmax_share == 0.667


def test_dim_date_is_distinct_observed_days(spark):
    dd = {r.date_day: r for r in models.dim_date(models.stg_observations(_raw_obs(spark))).collect()}
    assert len(dd) == 4
    r = dd[D(2024, 7, 1)]
    assert (r.year, r.month, r.day, r.season) == (2024, 7, 1, "summer")
    assert dd[D(2023, 12, 31)].season == "winter"


def test_distinct_counts_null_key_once(spark):
    obs = spark.createDataFrame([("CA1",), ("CA1",), (None,)], "id string")
    v = profiling.volume(obs).first()
    assert (v.rows, v.stations) == (3, 2)  # T17: a null id is one station, as distinct() counts it


def test_star_query_sums_by_province_and_season(spark):
    fct = models.stg_observations(_raw_obs(spark))
    dim_st = spark.createDataFrame([("CA1", "ON"), ("CA2", "QC")], "station_id string, province string")
    out = {(r.province, r.season): r for r in
           models.star_climate_by_province_season(fct, dim_st, models.dim_date(fct)).collect()}
    on = out[("ON", "winter")]
    assert (on.stations, on.station_days, on.tmax_days, on.avg_tmax_c) == (1, 2, 1, 5.0)
    assert out[("QC", "summer")].avg_prcp_mm is None  # no precipitation reported: null, not an error


def test_exact_mean_ties_signs_and_partitioning(spark):
    from pyspark.sql import functions as F

    # 400 values averaging exactly 0.69175: a tie at 4 decimals, rounded half away from zero
    vals = [0.7] * 367 + [0.6] * 33
    assert sum(round(v * 10) for v in vals) == 2767
    df = spark.createDataFrame([(v, -v) for v in vals], "x double, y double")
    for parts in (1, 3, 7):
        r = df.repartition(parts).agg(
            models.exact_mean("x", 10, 4).alias("x"), models.exact_mean("y", 10, 4).alias("y")).first()
        assert (r.x, r.y) == (0.6918, -0.6918)
    empty = spark.createDataFrame([(None,)], "x double").agg(models.exact_mean("x", 10, 4).alias("m"))
    assert empty.first().m is None
    ints = spark.createDataFrame([(1,), (2,)], "s int").agg(models.exact_mean("s", 1, 4).alias("m"))
    assert ints.first().m == 1.5
    assert F is not None
