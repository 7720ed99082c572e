"""The 26 declared tests and the violation checks, each on planted violations."""

import datetime as dt

from wxstar.operators import models, validation

D = dt.date


def _star(spark, planted: bool):
    stations = [("CA1", 45.0, -75.0, 100.0, "ON", "A", None, None, None),
                ("CA2", 46.0, -76.0, 110.0, "QC", "B", None, None, "71000")]
    if planted:
        stations += [("CA2", 47.0, -77.0, 120.0, "QC", "B2", None, None, None),  # duplicate id
                     (None, 48.0, -78.0, 130.0, "QC", "C", None, None, None)]    # null id
    obs = [("CA1", D(2024, 1, 1), 5.0, 1.0, 0.0, 3.0, 0, 0),
           ("CA1", D(2024, 1, 2), 6.0, 2.0, 0.0, 4.0, 0, 0),
           ("CA2", D(2024, 1, 4), 7.0, 1.0, 0.0, 4.0, 0, 0)]
    if planted:
        obs += [("CA9", D(2024, 1, 2), 1.0, 5.0, 0.0, 3.0, 0, 0),    # orphan station, tmax < tmin
                (None, D(2024, 1, 2), 2.0, 1.0, 0.0, 1.0, 0, 0)]     # null key: not an orphan
    st = spark.createDataFrame(stations, "id string, latitude double, longitude double, elevation double, state string, "
                               "name string, gsn_flag string, hcn_crn_flag string, wmo_id string")
    raw = spark.createDataFrame(obs, "id string, date date, tmax double, tmin double, prcp double, tavg double, "
                                "snow int, snwd int")
    fct = models.stg_observations(raw)
    dim_st = models.stg_stations(st)
    dim_dt = models.dim_date(fct)
    if planted:  # a season outside the four values, and an orphan date (dim without Jan 4)
        dim_dt = dim_dt.filter("date_day <> date'2024-01-04'").unionByName(
            spark.createDataFrame([(D(2024, 7, 1), 2024, 7, 1, "monsoon")], dim_dt.schema))
    mart = models.mart_yearly_climate(fct)
    return st, raw, dim_dt, dim_st, fct, mart


def test_suite_passes_on_clean_star(spark):
    res = validation.run_data_tests(*_star(spark, planted=False)).collect()
    assert len(res) == 26
    assert {r.test_name: r.failures for r in res if r.failures} == {}


def test_suite_reports_planted_violations(spark):
    res = {r.test_name: r.failures for r in validation.run_data_tests(*_star(spark, planted=True)).collect()}
    assert len(res) == 26
    assert res["not_null_raw_stations_id"] == 1
    assert res["unique_raw_stations_id"] == 1
    assert res["not_null_raw_observations_id"] == 1
    assert res["relationships_raw_observations_id"] == 1      # CA9 only; the null key is not an orphan
    assert res["accepted_values_dim_date_season"] == 1
    assert res["relationships_fct_daily_weather_observation_date"] == 1
    assert res["assert_tmax_not_below_tmin"] == 1
    assert res["unique_dim_station_station_id"] == 1


def test_calendar_gaps(spark):
    _, raw, *_ = _star(spark, planted=False)
    gaps = [r.missing_date for r in validation.calendar_gaps(models.stg_observations(raw)).collect()]
    assert gaps == [D(2024, 1, 3)]


def test_accepted_values_ignores_null(spark):
    df = spark.createDataFrame([("winter",), (None,), ("monsoon",), ("monsoon",)], "season string")
    r = validation.check_accepted_values(df, "season").collect()
    assert [(x.season, x.n_records) for x in r] == [("monsoon", 2)]


def test_reconcile_full_outer(spark):
    a = spark.createDataFrame([(1990, 10), (1991, 11)], "y int, n long")
    b = spark.createDataFrame([(1991, 12), (1992, 5)], "y int, n long")
    rows = {r.y: r for r in validation.reconcile(a, b, "y", ["n"]).collect()}
    assert rows[1990].right_n is None and rows[1991].diff_n == -1 and rows[1992].left_n is None


def test_rerun_diff(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    rows = sorted((r.k, r.side, r.copies) for r in validation.rerun_diff(a, b).collect())
    assert rows == [(1, "old_only", 1), (3, "new_only", 1)]
    assert validation.rerun_diff(a, a).count() == 0


def _rows(spark, df, rows):
    from pyspark.sql.types import StructField, StructType

    schema = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return spark.createDataFrame(rows, schema)


def test_every_declared_test_can_fail(spark):
    """A star with one planted violation per declared test: all 26 report failures."""
    st, raw, dim_dt, dim_st, fct, mart = _star(spark, planted=True)
    # raw observations: a null date
    raw = raw.unionByName(_rows(spark, raw, [("CA1", None, 1.0, 0.0, 0.0, 0.0, 0, 0)]))
    # dim_date: a null key, null parts, and a duplicated day
    dim_dt = dim_dt.unionByName(_rows(
        spark, dim_dt, [(None, None, None, None, "winter"), (D(2024, 1, 1), 2024, 1, 1, "winter")]))
    # dim_station: a row with every tested column null
    dim_st = dim_st.unionByName(_rows(spark, dim_st, [(None, None, None, None, "ON", None, None, None, None)]))
    # fact: a null date (the null station id is already planted)
    fct = fct.unionByName(_rows(spark, fct, [("CA1", None, 1.0, 0.0, 0.0, 0.0, 0, 0)]))
    # mart: a row with every tested column null
    mart = mart.unionByName(_rows(spark, mart, [tuple([None] * len(mart.columns))]))
    res = {r.test_name: r.failures for r in validation.run_data_tests(st, raw, dim_dt, dim_st, fct, mart).collect()}
    assert len(res) == 26
    assert [name for name, n in res.items() if n == 0] == []
