"""Landing: the manifest of a stream, yearly files re-laid into ordered parts, years from file names."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from test_sinks_jobs import _land
from wxstar.plans import jobs, lake
from wxstar.sources.files import YEAR_PARTS, read_observations, read_station_days, year_paths
from wxstar.streaming import incremental


def test_a_batch_reads_only_files_of_its_years(spark, tmp_path, monkeypatch):
    """50 landed files of ten years, then one more of a single year."""
    src, out = tmp_path / "landing", str(tmp_path / "out")
    for i in range(50):
        _land(src, f"{2000 + i % 10}_{i:02d}.csv.gz", [f"{2000 + i % 10}{1 + i // 10:02d}05"])
    read = []
    real = incremental.read_observations

    def counted(session, files, **kw):
        read.append(sorted(files))
        return real(session, files, **kw)

    monkeypatch.setattr(incremental, "read_observations", counted)
    run = lambda: incremental.start_incremental_ingest(spark, str(src), out, checkpoint=str(tmp_path / "ck")).awaitTermination()
    run()
    assert [len(files) for files in read] == [50]
    _land(src, "2003_new.csv.gz", ["20031205", "junk", "20030230"])
    run()
    assert len(read) == 2 and len(read[1]) == 6 and all("/2003_" in f for f in read[1])
    days = read_station_days(spark, f"{out}/processed/observations.parquet")
    assert {r.year: r["count"] for r in days.groupBy("year").count().collect()} == {y: 6 if y == 2003 else 5 for y in range(2000, 2010)}
    noted = spark.read.schema("file string, year int, rows bigint, batch bigint").parquet(incremental.manifest_path(out))
    assert noted.agg(F.sum("rows")).first()[0] == 53 and noted.filter("batch = 1").count() == 1


def test_rows_of_no_year_are_kept_once_by_batch(spark, tmp_path):
    src, out = tmp_path / "landing", str(tmp_path / "out")
    _land(src, "a.csv.gz", ["20240105", "junk"])
    run = lambda: incremental.start_incremental_ingest(spark, str(src), out, checkpoint=str(tmp_path / "ck")).awaitTermination()
    run()
    _land(src, "b.csv.gz", ["20240205", "waste", "trash"])
    _land(src, "with space.csv.gz", ["20240305"])
    run()
    kept = spark.read.parquet(jobs.undated_path(out)).groupBy("years").count().collect()
    assert {r.years: r["count"] for r in kept} == {"batch-0": 1, "batch-1": 2}
    assert read_station_days(spark, f"{out}/processed/observations.parquet").count() == 3


def test_a_landed_year_is_many_ordered_files(spark, tmp_path):
    """Repeated cells resolve to the first row of the source wherever the files are cut, and one year gives many tasks."""
    src, root, namespace = tmp_path / "src", str(tmp_path / "lake"), f"ns_{uuid.uuid4().hex[:8]}"
    import gzip

    src.mkdir()
    with gzip.open(src / "2024.csv.gz", "wt") as f:
        for copy in range(5):
            for i in range(200):
                f.write(f"CA{i % 20:09d},2024{1 + i // 20:02d}05,TMAX,{10 * i + copy},,,S,\n")
    lake.land(spark, str(src), namespace, root, [2024], rows_per_file=64)
    landed = spark.table(f"{namespace}.landed")
    assert len(landed.inputFiles()) == 16 and landed.count() == 1000
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        assert spark.table(f"{namespace}.landed").rdd.getNumPartitions() > 4
        lake.ingest_landed(spark, namespace, root, [2024])
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    got = spark.table(f"{namespace}.station_days").agg(F.count("*"), F.sum(F.round(F.col("tmax") * 10).cast("bigint"))).first()
    assert tuple(got) == (200, sum(10 * i for i in range(200)))
    direct, _ = jobs.ingest_year(spark, str(src), str(tmp_path / "o"), 2024)
    same = read_station_days(spark, direct).select("id", "date", "tmax")
    assert same.exceptAll(spark.table(f"{namespace}.station_days").select("id", "date", "tmax")).isEmpty()


def test_parts_of_a_year_and_names_without_one(spark, tmp_path):
    src = tmp_path / "src"
    _land(src, "1998-00000.csv.gz", ["19980105"])
    _land(src, "1998-00001.csv.gz", ["19980205"])
    _land(src, "1999.csv.gz", ["19990105"])
    _land(src, "19980.csv.gz", ["19980305"])  # another name altogether
    count = lambda years: read_observations(spark, year_paths(str(src), years, YEAR_PARTS)).count()
    assert count([1998]) == 2 and count([1998, 1999]) == 3
    _land(src, "yearless.csv.gz", ["20000105"])
    with pytest.raises(PySparkException, match="cannot infer year from file name: yearless"):
        read_observations(spark, str(src), with_file_year=True).agg(F.max("file_year")).collect()
