"""The parts of a landing grow in number with the rows, not in size."""

import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from wxstar.functions.scalar import year_from_path, year_in_path
from wxstar.plans import catalog_queries, files, lake
from wxstar.session import scratch_dir

ROWS = 600


@pytest.fixture(scope="module")
def tables_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    days = [dt.datetime(1995 + i % 7, 1 + i % 12, 1 + i % 28) for i in range(ROWS)]
    lines = [(i // 7, i % 3, 1 + i % 7, float(i % 50), 0.05, 0.02, "N", "O", d) for i, d in enumerate(days)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
                                 "l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(i, f"s{i}", 3, 100.0) for i in range(3)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
                          ).write.parquet(f"{root}/supplier.parquet")
    return root


def counted(spark, path):
    """Rows of each file."""
    return [r.n for r in spark.read.text(path).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]


def test_yearly_parts_hold_few_rows(spark, tables_dir, monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_PART", 20, raising=False)
    sizes = counted(spark, files._yearly_files(spark, files._raw(spark, tables_dir)))
    assert sum(sizes) == ROWS and max(sizes) <= 40


@pytest.mark.parametrize("query, landing", [("duplicate_cells_multi_file", "many-*"), ("stream_values", "landing-*/*")])
def test_landings_have_a_part_for_so_many_rows(spark, tables_dir, monkeypatch, query, landing):
    monkeypatch.setattr(files, "ROWS_PER_PART", 20, raising=False)
    at = f"{re.sub('^file:/+', '/', scratch_dir(spark))}/{landing}/part-*"
    before = set(glob.glob(at))
    got = files.QUERIES[query](spark, tables_dir)
    sizes = counted(spark, list(set(glob.glob(at)) - before))
    assert sum(sizes) == ROWS and max(sizes) <= 60
    monkeypatch.setattr(files, "ROWS_PER_PART", 10 * ROWS, raising=False)
    assert got.exceptAll(files.QUERIES[query](spark, tables_dir)).count() == 0


def test_landed_files_stop_growing_in_number(spark, tables_dir, monkeypatch):
    monkeypatch.setattr(catalog_queries, "LANDED_ROWS", 1)
    monkeypatch.setattr(catalog_queries, "LANDED_FILES", 30, raising=False)
    asked = []
    land = lake.land
    monkeypatch.setattr(lake, "land", lambda *a, **k: (asked.append(k["rows_per_file"]), land(*a, **k)))
    days = catalog_queries.q_lake_landed(spark, tables_dir)
    assert asked == [ROWS // 30]
    assert days.count() and days.select("id", "date", "tmax", "snow", "year", "month").exceptAll(
        files.q_duplicate_cells_multi_file(spark, tables_dir).select("id", "date", "tmax", "snow", "year", "month")).count() == 0


def test_file_names_are_cut_without_a_search_from_every_place(spark):
    paths = ["/a/1990/b/1998-00001.csv.gz", "x1997.csv", "/1996/none.csv", "file:/" + "d" * 300 + "/2001.csv.gz", None, "/1995/"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(year_in_path("p")).collect()] == [1998, 1997, None, 2001, None, None]
    for year in (year_in_path, year_from_path):
        assert "[^/]" not in plan_text(df.select(year("p").alias("y")))
