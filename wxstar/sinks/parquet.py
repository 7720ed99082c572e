"""Parquet sinks.

Replace semantics: Spark's *dynamic* partition overwrite replaces only the partitions
present in the new output, so a month that vanished from a year's re-run would stay
stale. ``replace_years`` therefore swaps every listed year directory as a whole: a year
is the unit of replacement.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARTITION_COLS = ("year", "month")
CURRENT = "CURRENT"  # pointer file of tables that are loaded together


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``year=/month=`` layout. Rows are clustered by (year, month) with a ``rebalance``
    hint rather than ``repartition``: a month still lands in few files, but with AQE a
    month holding a large share of the rows is split over several tasks (and tiny months
    are coalesced) instead of running as one straggler."""
    (
        df.hint("rebalance", *PARTITION_COLS)
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")  # not the session's: a fresh write replaces all
        .partitionBy(*PARTITION_COLS)
        .parquet(path)
    )


def write_station_days(df: DataFrame, root: str) -> str:
    path = f"{root.rstrip('/')}/processed/observations.parquet"
    write_partitioned(df, path)
    return path


def write_quarantine(df: DataFrame, root: str) -> str:
    path = f"{root.rstrip('/')}/quarantined/observations.parquet"
    write_partitioned(df, path)
    return path


def replace_years(df: DataFrame, path: str, years: Iterable[int]) -> None:
    """Replace each ``year=Y`` directory under ``path`` with exactly the rows of ``df``
    for that year (also when ``df`` has none for a month, or none at all for the year).

    One job writes all years beside the target, whatever their number; only when it has
    ended well are the year directories swapped, so a failed write leaves the old years in
    place. Other years are never touched, reruns are idempotent, and the session's
    overwrite mode plays no part.
    """
    years, root = sorted(set(years)), path.rstrip("/")
    spark = df.sparkSession
    stage = f"{root}.staged-{uuid.uuid4().hex[:12]}"
    write_partitioned(df.filter(F.col("year").isin(years)), stage)
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    at = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join(parts))
    fs.mkdirs(at(root))
    for y in years:
        new, old = at(stage, f"year={y}"), at(root, f"year={y}")
        fs.delete(old, True)
        if fs.exists(new) and not fs.rename(new, old):
            raise OSError(f"could not move {new} to {old}")
    fs.delete(at(stage), True)
    spark.catalog.refreshByPath(root)


def undated_name(years: Iterable[int]) -> str:
    return "-".join(str(y) for y in sorted(set(years))) or "none"


def replace_undated(df: DataFrame, path: str, years: Iterable[int], key: str | None = None) -> None:
    """Rows without any year (no usable date text, no year in the file name) from a run
    that replaces ``years``: written to ``{path}/years=<y1-y2..>``, replaced when the same
    year set is rerun, so they are neither lost nor duplicated (``key`` names a run that always sees all of them). Kept outside the
    ``year=/month=`` tree, whose partition layout they do not fit."""
    key = key or undated_name(years)
    (
        df.filter(F.col("year").isNull()).drop("year", "month")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .parquet(f"{path.rstrip('/')}/years={key}")
    )


def write_stations(df: DataFrame, path: str) -> None:
    """Full overwrite of the station table (it is small and always rebuilt whole)."""
    df.write.mode("overwrite").parquet(path)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of a declared table, by name and in declared order, each cast to its
    declared type (``try_cast``: a value that does not fit becomes null and is then caught
    by the not_null tests, since Spark does not enforce NOT NULL on file writes). A
    missing column is an error before anything is written."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for the declared table: {missing}")
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def atomic_replace(
    spark: SparkSession, df: DataFrame, table_root: str, name: str, schema: StructType | None = None,
    expected_rows: int | None = None,
) -> DataFrame:
    """Load-then-swap replace of a table, all or nothing.

    The new content is written under a fresh version folder and its rows counted in that write;
    only a right count (``expected_rows``, when given) repoints the name, a catalog view that every session
    sees. A failed write leaves the previous version serving. Columns are selected by name in the declared order.
    """
    from wxstar.sinks.catalog import publish_view

    return publish_view(spark, df, name, table_root, schema, expected_rows)


def load_together(
    spark: SparkSession, tables: dict[str, tuple[DataFrame, StructType, int | None]], root: str,
) -> dict[str, DataFrame]:
    """All-or-nothing load of several tables: ``name -> (rows, schema, expected row count)``.

    Every table is written and counted under one fresh version folder; one rename of the
    pointer file then switches all of them, for every session. A failed write or a wrong
    count raises before that, and readers keep the previous version of every table. Old
    version folders stay for readers that still use them.
    """
    root, version = root.rstrip("/"), f"v-{uuid.uuid4().hex[:12]}"
    for name, (df, schema, expected) in tables.items():
        path = f"{root}/{version}/{name}"
        conform(df, schema).write.mode("errorifexists").parquet(path)
        if expected is not None and (n := spark.read.schema(schema).parquet(path).count()) != expected:
            raise ValueError(f"{name}: loaded {n} rows, expected {expected}; nothing switched")
    jvm = spark._jvm
    new, current = (jvm.org.apache.hadoop.fs.Path(f"{root}/{n}") for n in (f"pointer.{version}", CURRENT))
    conf = spark._jsc.hadoopConfiguration()
    out = new.getFileSystem(conf).create(new)
    out.write(bytearray(version, "ascii"))
    out.close()
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf).rename(new, current, rename)
    return {name: read_loaded(spark, root, name, schema) for name, (_, schema, _) in tables.items()}


def read_loaded(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """The version of a table of :func:`load_together` that the pointer names now."""
    root = root.rstrip("/")
    version = spark.read.text(f"{root}/{CURRENT}").first().value
    return spark.read.schema(schema).parquet(f"{root}/{version}/{name}")


BUCKET_BYTES = 256 << 20


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES, most: int = 4096) -> int:
    """Buckets of about ``bucket_bytes`` by the planner's size of ``df``; a power of two, so that tables written at different
    sizes still meet without a full exchange."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(most, 1 << max(0, (size - 1) // bucket_bytes).bit_length())


def write_bucketed(
    df: DataFrame, table: str, key: str, buckets: int | None = None, sort: str | None = None, path: str | None = None,
) -> int:
    """``df`` as a table bucketed by ``key`` (and sorted within buckets): work on the key, and joins with tables bucketed
    alike, need no exchange. Rows are dealt by key first, so a bucket is one sorted file instead of one per task.
    Returns the number of buckets (:func:`bucket_count` where none is given)."""
    buckets = buckets or bucket_count(df)
    w = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(sort or key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return buckets


def write_bucketed_fact(fct: DataFrame, table: str, buckets: int | None = None, path: str | None = None) -> int:
    """Fact layout for station-keyed work: bucketed by ``station_id`` and sorted by date,
    so a distinct count of stations per year or a join on station needs no exchange on
    the station key (the warehouse's distribution/sort keys, re-expressed)."""
    return write_bucketed(fct, table, "station_id", buckets, "observation_date", path)


def table_name(layer: str | None, target: str = "dev", default_schema: str = "public") -> str:
    """Output namespace: the default schema when no layer is set; the bare layer name in
    ``prod``; ``<default>_<layer>`` anywhere else."""
    if layer is None:
        return default_schema
    if target == "prod":
        return layer.strip()
    return f"{default_schema}_{layer.strip()}"


def materialize(spark: SparkSession, df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """Staging models are views (recomputed on read); marts are tables: an external catalog table
    whose location is switched to the version just written under ``path``, never overwritten in place."""
    from wxstar.sinks.catalog import publish_table

    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(f"unknown materialisation {kind!r}")
    if not path:
        raise ValueError("a table needs a path")
    spark.catalog.dropTempView(name)  # a temp view of that name would shadow the table
    return publish_table(spark, df, name, path)
