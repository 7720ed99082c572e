"""Trend reports and the share column, checked against the published yearly extracts."""

from wxstar.operators import models, trends

# The published yearly reconciliation extract
# (observation_year, station_count, station_days, tmax_days, tmax_share, avg_tmax_c).
RECONCILIATION = [
    (1990, 2595, 847169, 705005, 0.832, 9.8),
    (2005, 2071, 656153, 585442, 0.892, 9.29),
    (2022, 1882, 541898, 338944, 0.625, 8.74),
    (2023, 1816, 523489, 326801, 0.624, 10.05),
    (2024, 1782, 327416, 120013, 0.367, 2.39),
    (2025, 1299, 355801, 167768, 0.472, 8.41),
]


def _mart(spark):
    return spark.createDataFrame(
        RECONCILIATION,
        "observation_year int, station_count long, station_days long, tmax_days long, tmax_share double, avg_tmax_c double",
    )


def test_tmax_share_matches_published(spark):
    m = models.with_tmax_share(_mart(spark).drop("tmax_share"))
    got = {r.observation_year: r.tmax_share for r in m.collect()}
    assert got == {r[0]: r[4] for r in RECONCILIATION}


def test_low_year_and_labelled_counts(spark):
    assert trends.low_year(_mart(spark)).first().observation_year == 2024
    r = trends.first_last_complete(_mart(spark), incomplete_from=2024).first()
    assert (r.first_year, r.first_station_count, r.last_complete_year, r.last_complete_station_count) == (
        1990, 2595, 2023, 1816)
    flags = {x.observation_year: x.incomplete for x in trends.incomplete_flag(_mart(spark)).collect()}
    assert flags[2023] is False and flags[2024] is True and flags[2025] is True


def test_yoy_change(spark):
    yearly = spark.createDataFrame([(2022, 541898), (2023, 523489), (2024, 327416)], "year int, count long")
    rows = trends.with_yoy_change(yearly).orderBy("year").collect()
    assert rows[0].previous_year_count is None and rows[0].change_pct is None
    assert rows[2].previous_year_count == 523489
    assert rows[2].change_pct == round((327416 - 523489) / 523489 * 100, 2)  # the ~37 % drop


def test_monthly_counts(spark):
    import datetime as dt

    sd = spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), 1.0, 2024, "01"), ("A", dt.date(2024, 2, 1), None, 2024, "02"),
         ("B", dt.date(2023, 2, 1), 1.0, 2023, "02")],
        "id string, date date, tmax double, year int, month string")
    assert [(r.month, r["count"]) for r in trends.monthly_counts(sd, 2024).collect()] == [("01", 1), ("02", 1)]
    assert [(r.month, r["count"]) for r in trends.monthly_counts(sd, 2024, "tmax").collect()] == [("01", 1)]


def test_reconcile_against_published_extract(spark):
    from wxstar.operators.validation import reconcile

    published = _mart(spark).select("observation_year", "station_count", "station_days", "tmax_days")
    from pyspark.sql import functions as F

    ours = published.filter("observation_year <> 2025").withColumn(
        "station_days",
        F.when(F.col("observation_year") == 2024, F.col("station_days") + 1).otherwise(F.col("station_days")))
    rows = {r.observation_year: r for r in
            reconcile(ours, published, "observation_year", ["station_count", "station_days", "tmax_days"],
                      "mart", "published").collect()}
    assert len(rows) == 6
    assert all(rows[y].diff_station_count == 0 and rows[y].diff_tmax_days == 0 for y in (1990, 2005, 2022, 2023, 2024))
    assert rows[2024].diff_station_days == 1           # a planted difference shows up
    assert rows[2025].mart_station_days is None         # a year missing on one side shows up
    assert rows[1990].diff_station_days == 0
