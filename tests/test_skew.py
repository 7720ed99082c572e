"""Skew: one key holding a third of all rows must not change results, and the heavy
operators must pre-aggregate before they shuffle."""

from conftest import obs_rows, plan_text
from pyspark.sql import functions as F

from wxstar.operators.observations import station_days_from_raw
from wxstar.operators.profiling import coverage_by_year, grain_check
from wxstar.operators.validation import check_unique, rerun_diff


def _skewed(spark, n=3000):
    base = [(f"CA{i % 50:09d}", f"2024{1 + i % 12:02d}{1 + i % 28:02d}", "TMAX", str(i % 300), None, None, "S", None)
            for i in range(2 * n)]
    hot = [("CA000000007", "20240101", "TMAX", "42", None, None, "S", None)] * n  # a third of all rows
    return obs_rows(spark, base + hot)


def test_hot_key_results_are_exact(spark):
    raw = _skewed(spark)
    g = {r.scope: r for r in grain_check(raw).collect()}
    assert g["whole"].rows == 9000
    hot_day = station_days_from_raw(raw).filter((F.col("id") == "CA000000007") & (F.col("date") == "2024-01-01"))
    assert hot_day.count() == 1
    dup = check_unique(raw, ["id", "date", "element"]).filter((F.col("id") == "CA000000007") & (F.col("date") == "20240101")).first()
    assert dup.n_records >= 3000
    cov = coverage_by_year(raw.withColumn("y", F.lit(2024)), year_col="y").first()
    assert cov.total_rows == 9000 and cov.ca_stations == 50
    assert rerun_diff(raw, raw).count() == 0


def test_heavy_operators_aggregate_before_the_exchange(spark):
    raw = _skewed(spark, 10)
    for df in (station_days_from_raw(raw), check_unique(raw, ["id", "date", "element"]), rerun_diff(raw, raw)):
        plan = plan_text(df)
        tree = plan.split("\n\n")[0]
        first_exchange = tree.rfind("Exchange")
        assert first_exchange > 0
        # below (after, in the printed tree) the deepest exchange sits a partial HashAggregate
        assert "HashAggregate" in tree[first_exchange:], tree
        assert "partial_" in plan
