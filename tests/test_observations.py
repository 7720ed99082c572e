"""Prepare -> split -> pivot -> scale, on the FIXTURES.md cases."""

import datetime as dt

from conftest import obs_rows, plan_text

from wxstar.operators.observations import (
    prepare_observations,
    split_by_quality,
    station_days_from_raw,
    to_station_days,
    transform_observations,
)
from wxstar.operators.profiling import grain_check, value_checks

ROWS = [
    ("CA000000001", "20240101", "TMAX", "-105", None, None, "S", None),
    ("CA000000001", "20240101", "SNOW", "12", None, None, "S", None),
    ("CA000000001", "20240102", "TMAX", "300", None, "X", "S", None),
    ("CA000000001", "20240103", "TMAX", None, None, "", "S", "0700"),
    ("CA000000001", "20240104", "TMIN", "bad", None, None, "S", None),
    ("CA000000001", "20240230", "TMIN", "5", None, None, "S", None),
    ("US000000001", "20240101", "TMAX", "10", None, None, "S", None),
    ("CA000000001", "20240101", "WT01", "1", None, None, "S", None),
    ("CA000000002", "20240201", "PRCP", "30", None, None, "S", None),
    ("CA000000002", "20240201", "PRCP", "10", None, None, "S", None),
]


def _days(spark):
    return {(r.id, r.date): r for r in station_days_from_raw(obs_rows(spark, ROWS)).collect()}


def test_per_element_scaling(spark):
    d = _days(spark)[("CA000000001", dt.date(2024, 1, 1))]
    assert d.tmax == -10.5
    assert d.snow == 12 and isinstance(d.snow, int)  # not divided
    assert d.year == 2024 and d.month == "01"


def test_quarantined_only_row_gives_no_station_day(spark):
    assert ("CA000000001", dt.date(2024, 1, 2)) not in _days(spark)


def test_blank_flag_is_clean_and_null_value_keeps_day(spark):
    d = _days(spark)[("CA000000001", dt.date(2024, 1, 3))]
    assert d.tmax is None


def test_non_numeric_is_null_cell_not_error(spark):
    d = _days(spark)[("CA000000001", dt.date(2024, 1, 4))]
    assert d.tmin is None
    vc = value_checks(obs_rows(spark, ROWS)).first()
    assert vc.non_numeric == 2  # 'bad' and the null value
    assert vc.sentinel_rows == 0


def test_bad_date_is_quarantined_with_reason(spark):
    clean, rejected = split_by_quality(prepare_observations(obs_rows(spark, ROWS)))
    reasons = {(r.element, r.reason, r.year, r.month) for r in rejected.collect()}
    assert ("TMIN", "bad_date", 2024, "02") in reasons
    assert ("TMAX", "q_flag", 2024, "01") in reasons
    assert clean.filter("date is null").count() == 0


def test_scope_drops_other_country_and_elements(spark):
    prepared = prepare_observations(obs_rows(spark, ROWS))
    assert prepared.filter("id like 'US%'").count() == 0
    assert prepared.filter("element = 'WT01'").count() == 0


def test_duplicate_cell_is_deterministic_and_counted(spark):
    d = _days(spark)[("CA000000002", dt.date(2024, 2, 1))]
    assert d.prcp == 1.0  # smallest value without an order key
    g = {r.scope: r for r in grain_check(obs_rows(spark, ROWS)).collect()}
    assert g["pipeline"].duplicates == 1
    assert g["whole"].rows == len(ROWS)


def test_order_key_picks_first_row(spark):
    from pyspark.sql import functions as F

    rows = obs_rows(spark, ROWS[8:10]).withColumn("pos", F.monotonically_increasing_id())
    clean, _ = split_by_quality(prepare_observations(rows))
    r = to_station_days(clean, order_key="pos").first()
    assert r.prcp == 30


def test_short_row_missing_tail_is_null(spark, tmp_path):
    from wxstar.sources.files import read_observations

    p = tmp_path / "2024.csv"
    p.write_text("CA000000003,20240105,TMAX,55\n")
    r = read_observations(spark, str(p)).first()
    assert r.data_value == "55" and r.q_flag is None and r.obs_time is None


def test_pivot_is_one_exchange(spark):
    clean, _ = split_by_quality(prepare_observations(obs_rows(spark, ROWS)))
    plan = plan_text(transform_observations(clean))
    assert plan.count("hashpartitioning(") == 1, plan


def test_profile_report_equals_per_report_functions(spark):
    from wxstar.operators import profiling as P

    ddl = ", ".join(f"{c} string" for c in ["id", "date", "element", "data_value", "m_flag", "q_flag", "s_flag",
                                              "obs_time"])
    raw = obs_rows(spark, ROWS).unionByName(
        spark.createDataFrame([(None, "20240101", "TMAX", "1", None, "Q", "S", None)], ddl))
    keys = P.profile_keys(raw).checkpoint()  # materialised once, reused by every report
    rep = P.profile_report(raw, keys=keys)
    singles = {
        "volume": P.volume(raw), "country_mix": P.country_mix(raw), "country_ratio": P.country_ratio(raw),
        "element_mix": P.element_mix(raw), "core_element_mix": P.core_element_mix(raw),
        "flag_mix": P.flag_mix(raw), "failed_qc": P.failed_qc(raw),
    }
    for name, df in singles.items():
        assert rep[name].columns == df.columns, name
        assert sorted(map(tuple, rep[name].collect()), key=str) == sorted(map(tuple, df.collect()), key=str), name
