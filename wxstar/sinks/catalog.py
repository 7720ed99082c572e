"""Catalog tables and views whose content is switched by location.

Nothing that readers use is ever overwritten or deleted in place. New content is written under a fresh
version folder, checked, and then a catalog entry is pointed at it: the location of a table, the text of a
view, or the location of one year of a year-partitioned table. A crash before that leaves the old content
serving, whole; one between two switches leaves each year either old or new, whole, and a rerun ends it.
Entries are seen by every session of the catalog. Folders that no entry names stay for running readers
until :func:`drop_unused_versions` removes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wxstar.sinks.parquet import conform

VERSIONS = "_versions"


def new_version(root: str) -> str:
    """A fresh folder for one run's output."""
    return f"{root.rstrip('/')}/{VERSIONS}/v-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def create_namespace(spark: SparkSession, namespace: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(namespace)}")
    return namespace


# --- whole tables ---------------------------------------------------------------


def observed(seen: Observation) -> dict[str, int]:
    """The metrics of a finished write. Where the adaptive plan finds its input empty it drops the observation with the
    rest of the plan: then there are none."""
    return seen.get if seen._jo.getRow().length() else {}


def _written(spark: SparkSession, df: DataFrame, root: str, name: str, schema: StructType | None, expected_rows: int | None) -> str:
    """Writes a version, counting its rows in the write itself; raises on a wrong count, before any switch."""
    path = f"{new_version(root)}/{name.rsplit('.', 1)[-1]}"
    rows = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    (conform(df, schema) if schema else df).observe(rows, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path)
    if expected_rows is not None and (n := observed(rows).get("n", 0)) != expected_rows:
        raise ValueError(f"{name}: wrote {n} rows, expected {expected_rows}; not switched")
    return path


def publish_table(
    spark: SparkSession, df: DataFrame, name: str, root: str, schema: StructType | None = None, expected_rows: int | None = None,
) -> DataFrame:
    """``name`` as an external table over the version just written and checked."""
    path = _written(spark, df, root, name, schema, expected_rows)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    else:
        spark.sql(f"ALTER TABLE {_name(name)} SET LOCATION {_quoted(path)}")
        spark.catalog.refreshTable(name)
    return spark.table(name)


def publish_view(
    spark: SparkSession, df: DataFrame, name: str, root: str, schema: StructType | None = None, expected_rows: int | None = None,
) -> DataFrame:
    """``name`` as a catalog view over the version just written and checked: every session's next query reads it."""
    path = _written(spark, df, root, name, schema, expected_rows)
    spark.sql(f"CREATE OR REPLACE VIEW {_name(name)} AS SELECT * FROM parquet.`{path}`")
    return spark.table(name)


def staging_view(spark: SparkSession, name: str, source: str, renames: dict[str, str]) -> DataFrame:
    """A catalog view that renames columns of another entry; recomputed on read, in any session."""
    columns = ", ".join(f"`{a}` AS `{b}`" for a, b in renames.items())
    spark.sql(f"CREATE OR REPLACE VIEW {_name(name)} AS SELECT {columns} FROM {_name(source)}")
    return spark.table(name)


# --- tables by year --------------------------------------------------------------


def year_table(spark: SparkSession, name: str, schema: StructType, root: str, by: str = "year") -> str:
    """An empty table partitioned by ``by``, whose partitions have locations of their own; kept if it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    base = f"{root.rstrip('/')}/_base/{name.rsplit('.', 1)[-1]}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(name)} ({columns}) USING parquet PARTITIONED BY (`{by}`) LOCATION {_quoted(base)}")
    return name


def write_partitions(df: DataFrame, path: str, by: str = "year", cluster: tuple[str, ...] = ()) -> None:
    """One folder per value of ``by``; large values are split over tasks, rows of a file are sorted by ``cluster``, so a
    filter on it skips row groups."""
    df = df.hint("rebalance", by, *cluster)
    if cluster:
        df = df.sortWithinPartitions(by, *cluster)
    df.write.mode("errorifexists").partitionBy(by).parquet(path)


def partition_locations(spark: SparkSession, name: str, by: str = "year") -> dict[str, str]:
    """Partition value -> its folder now (one entry per calendar year)."""
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {_name(name)}").collect():
        value = row[0].split("=", 1)[1]
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {_name(name)} PARTITION (`{by}`={_quoted(value)})").collect()
        out[value] = next(r.data_type for r in detail if r.col_name == "Location")
    return out


def switch(spark: SparkSession, name: str, value, path: str, by: str = "year") -> None:
    """Points one partition at ``{path}/{by}={value}``; a value without rows gets an empty folder there."""
    folder = f"{path}/{by}={value}"
    fs, p = _fs(spark, folder)
    fs.mkdirs(p)
    which = f"PARTITION (`{by}`={_quoted(str(value))})"
    spark.sql(f"ALTER TABLE {_name(name)} ADD IF NOT EXISTS {which} LOCATION {_quoted(folder)}")
    spark.sql(f"ALTER TABLE {_name(name)} {which} SET LOCATION {_quoted(folder)}")


def replace_partitions(spark: SparkSession, tables: dict[str, DataFrame], values: Iterable, root: str, by: str = "year",
                       cluster: tuple[str, ...] = ()) -> str:
    """Replaces ``values`` of every table by exactly the rows given: all tables are written, each by one job, and only then
    is anything switched, value by value and the tables of a value together. Returns the version's folder."""
    values, version = sorted(set(values)), new_version(root)
    paths = {name: f"{version}/{name.rsplit('.', 1)[-1]}" for name in tables}
    for name, df in tables.items():
        write_partitions(df.filter(F.col(by).isin(values)), paths[name], by, cluster)
    for value in values:
        for name in tables:
            switch(spark, name, value, paths[name], by)
    return version


def drop_unused_versions(spark: SparkSession, root: str, names: Iterable[str], by: str = "year") -> list[str]:
    """Deletes the version folders under ``root`` that no partition of the tables ``names`` is in; only when no reader can
    still use them. Returns their names."""
    used = {p.split(f"/{VERSIONS}/", 1)[1].split("/", 1)[0]
            for name in names for p in partition_locations(spark, name, by).values() if f"/{VERSIONS}/" in p}
    fs, p = _fs(spark, f"{root.rstrip('/')}/{VERSIONS}")
    gone = []
    for status in fs.listStatus(p) if fs.exists(p) else []:
        if (version := status.getPath().getName()) not in used:
            fs.delete(status.getPath(), True)
            gone.append(version)
    return sorted(gone)
