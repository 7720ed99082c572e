"""Property tests: the pivot and the coverage report against brute force on random rows."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F
from hypothesis import strategies as st

from wxstar.operators.observations import station_days_from_raw
from wxstar.operators.profiling import coverage_by_year, grain_check
from wxstar.schemas import CORE_ELEMENTS, SCALE

IDS = ["CA000000001", "CA000000002", "US000000003", "CA000000004"]
DATES = ["20230101", "20230102", "20240229", "20240230", "20241231"]
ELEMENTS = CORE_ELEMENTS + ["WT01"]
VALUES = ["10", "-5", "0", "n/a", None, "123"]
FLAGS = [None, None, None, "", "X"]

row = st.tuples(st.sampled_from(IDS), st.sampled_from(DATES), st.sampled_from(ELEMENTS),
                st.sampled_from(VALUES), st.sampled_from(FLAGS))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, rows):
    data = [(i, d, e, v, None, q, "S", None, n) for n, (i, d, e, v, q) in enumerate(rows)]
    return spark.createDataFrame(
        data, "id string, date string, element string, data_value string, m_flag string, q_flag string, "
              "s_flag string, obs_time string, pos long")


def _date(text):
    try:
        return dt.datetime.strptime(text, "%Y%m%d").date()
    except ValueError:
        return None


def _int(text):
    try:
        return int(text)
    except (TypeError, ValueError):
        return None


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_pivot_matches_brute_force(spark, rows):
    cells = {}
    for n, (i, d, e, v, q) in enumerate(rows):
        day = _date(d)
        if not i.startswith("CA") or e not in CORE_ELEMENTS or (q or "").strip() or day is None:
            continue
        cells.setdefault((i, day), {}).setdefault(e, (n, _int(v)))  # first in source order wins
    expected = {}
    for key, by_el in cells.items():
        out = {}
        for e in CORE_ELEMENTS:
            v = by_el.get(e, (None, None))[1]
            out[e.lower()] = None if v is None else (v / SCALE[e] if e in SCALE else v)
        expected[key] = out
    got = {
        (r.id, r.date): {e.lower(): r[e.lower()] for e in CORE_ELEMENTS}
        for r in station_days_from_raw(_frame(spark, rows), order_key="pos").collect()
    }
    assert got == expected


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_coverage_and_grain_match_brute_force(spark, rows):
    per_year = defaultdict(lambda: {"rows": 0, "ca_rows": 0, "ca": set(), "TMAX": set(), "PRCP": set(), "TAVG": set()})
    for i, d, e, _v, _q in rows:
        y = per_year[int(d[:4])]
        y["rows"] += 1
        if i.startswith("CA"):
            y["ca_rows"] += 1
            y["ca"].add(i)
            if e in y:
                y[e].add(i)
    df = _frame(spark, rows).withColumn("year", F.substring("date", 1, 4).cast("int"))
    got = {r.year: r for r in coverage_by_year(df, year_col="year").collect()}
    assert set(got) == set(per_year)
    for year, y in per_year.items():
        r = got[year]
        assert (r.total_rows, r.ca_rows, r.ca_stations) == (y["rows"], y["ca_rows"], len(y["ca"]))
        assert (r.tmax_stations, r.prcp_stations, r.tavg_stations) == (len(y["TMAX"]), len(y["PRCP"]), len(y["TAVG"]))
    g = {r.scope: r for r in grain_check(_frame(spark, rows)).collect()}
    keys = {(i, d, e) for i, d, e, _, _ in rows}
    assert (g["whole"].rows, g["whole"].distinct_keys, g["whole"].station_days) == (
        len(rows), len(keys), len({(i, d) for i, d, _ in keys}))
    scope = [(i, d, e) for i, d, e, _, _ in rows if i.startswith("CA") and e in CORE_ELEMENTS]
    assert (g["pipeline"].rows, g["pipeline"].distinct_keys) == (len(scope), len(set(scope)))
