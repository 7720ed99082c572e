"""Plan assertions: what reaches the scan, what is pruned, how many exchanges."""

import datetime as dt

from conftest import obs_rows, plan_text

from wxstar.operators import models, trends
from wxstar.operators.observations import prepare_observations, station_days_from_raw
from wxstar.operators.validation import check_relationships
from wxstar.sinks.parquet import write_partitioned
from wxstar.sources.files import read_station_days

ROWS = [("CA000000001", "20240101", "TMAX", "10", None, None, "S", None),
        ("US000000001", "20240101", "TMAX", "10", None, None, "S", None)]


def test_country_prefix_pushed_to_parquet(spark, tmp_path):
    p = str(tmp_path / "raw")
    obs_rows(spark, ROWS).write.parquet(p)
    plan = plan_text(prepare_observations(spark.read.parquet(p)))
    assert "StringStartsWith(id,CA)" in plan
    assert "In(element" in plan


def test_year_filter_prunes_partitions_and_counts_read_no_columns(spark, tmp_path):
    p = str(tmp_path / "sd")
    write_partitioned(station_days_from_raw(obs_rows(spark, ROWS)), p)
    sd = read_station_days(spark, p)
    plan = plan_text(trends.monthly_counts(sd, 2024))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan and "= 2024)" in plan
    assert "ReadSchema: struct<>" in plan_text(trends.yearly_counts(sd))


def test_mart_distinct_count_partial_aggregates(spark):
    fct = models.stg_observations(station_days_from_raw(obs_rows(spark, ROWS)).drop("year", "month"))
    plan = plan_text(models.mart_yearly_climate(fct))
    assert "Expand" not in plan  # single distinct: two-level aggregate, no row copies
    assert "partial_count(" in plan


def test_orphans_are_an_anti_join(spark):
    child = spark.createDataFrame([("A",), ("B",), (None,)], "k string")
    parent = spark.createDataFrame([("A",)], "pk string")
    out = check_relationships(child, "k", parent, "pk")
    plan = plan_text(out)
    assert "LeftAnti" in plan and "LeftSemi" in plan
    assert [r.k for r in out.collect()] == ["B"]


def test_star_join_broadcasts_only_the_date_dimension(spark):
    fct = spark.createDataFrame([("CA1", dt.date(2024, 1, 1), 1.0, 0.0)],
                                "station_id string, observation_date date, tmax_c double, prcp_mm double")
    dim_st = spark.createDataFrame([("CA1", "ON")], "station_id string, province string")
    dim_dt = models.dim_date(fct)
    plan = plan_text(models.star_climate_by_province_season(fct, dim_st, dim_dt))
    assert "BroadcastHashJoin" in plan


def test_csv_pivot_with_source_order_stays_hash_aggregate(spark, tmp_path):
    import gzip

    from wxstar.operators.observations import split_by_quality, transform_observations
    from wxstar.sources.files import read_observations, with_source_order

    with gzip.open(tmp_path / "2024.csv.gz", "wt") as f:
        f.write("CA000000002,20240201,PRCP,30,,,S,\n")
    raw = read_observations(spark, str(tmp_path / "2024.csv.gz"), with_position=True)
    clean, _ = split_by_quality(with_source_order(prepare_observations(raw)))
    plan = plan_text(transform_observations(clean, "src_order"))
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert "StringStartsWith(id,CA)" in plan  # the position is added after the pushed filter


def test_registered_plans_avoid_row_copies_and_cross_products(spark):
    """Every lazily built registered query: no Expand, nested-loop or cartesian join,
    and no sort-based aggregation over sorted input."""
    import os

    import __spark_entry__ as E
    from wxstar.plans import files

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    bad = {}
    for name, q in E._QUERIES.items():
        if name in files.QUERIES or name == "data_tests":  # these write or checkpoint first
            continue
        tree = plan_text(q(spark, sf)).split("\n\n")[0]
        lines = tree.split("\n")
        flags = [k for k in ("Expand", "BroadcastNestedLoopJoin", "CartesianProduct") if k in tree]
        flags += ["keyed SortAggregate" for i, l in enumerate(lines[:-1])
                  if "SortAggregate" in l and "Sort (" in lines[i + 1]]
        if flags:
            bad[name] = flags
    assert bad == {}
