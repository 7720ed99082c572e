"""Data-quality checks as DataFrames of violations (empty when the check passes), the
26-test suite over the star schema, reconciliation and rerun comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxstar.schemas import SEASONS


def _cols(c: str | Sequence[str]) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Key values occurring more than once (rows with a null key part are ignored)."""
    keys = _cols(columns)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return df.filter(present).groupBy(*keys).agg(F.count("*").alias("n_records")).filter(F.col("n_records") > 1)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-null child keys without a parent (column ``orphan_key``)."""
    keys = child.select(F.col(column).alias("orphan_key")).filter(F.col("orphan_key").isNotNull()).distinct()
    p = parent.select(F.col(parent_column).alias("__parent_key"))
    return keys.join(p, F.col("orphan_key") == F.col("__parent_key"), "left_anti")


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent (a null key is not an orphan).

    Two phases, so the child's rows never meet the parent directly: its distinct keys
    (map-side deduplicated, so a hot key costs one row) are anti-joined with the parent,
    then the child is semi-joined with the orphan keys. Those are usually few, and AQE
    broadcasts them from their measured size; many orphans fall back to a shuffle join.
    """
    orphans = orphan_keys(child, column, parent, parent_column)
    return child.join(orphans, F.col(column) == F.col("orphan_key"), "left_semi")


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str] = SEASONS) -> DataFrame:
    """Values outside the accepted list, with their row counts (null is not checked)."""
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.isin(list(values))).groupBy(column).agg(F.count("*").alias("n_records"))


def check_tmax_not_below_tmin(fct: DataFrame) -> DataFrame:
    return fct.filter(F.col("tmax_c") < F.col("tmin_c")).select(
        "station_id", "observation_date", "tmax_c", "tmin_c"
    )


def calendar_gaps(df: DataFrame, date_col: str = "observation_date") -> DataFrame:
    """Days between the first and last observed date on which nothing was observed.

    The calendar is generated from a one-row min/max aggregate (one row per day, so its
    size is bounded by the date range), then anti-joined with the distinct observed dates.
    """
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("missing_date"))
    seen = df.select(F.col(date_col).alias("__d")).distinct()  # at most one row per day in range
    return days.join(seen, F.col("missing_date") == F.col("__d"), "left_anti")


# --- the 26 declared tests ---------------------------------------------------
#
# Every test is a question about (set, key) groups: how often a key occurs in a set of keys as a child and as a
# parent, or whether a marker of a violating row occurs at all. So each table is read once, each row gives its keys and
# its markers, and one grouping over all sets at once answers every test of every table.

_ROW_TESTS = [  # not_null of columns that are no keys, by table
    ("raw_observations", "date"), ("dim_date", "year"), ("dim_date", "month"), ("dim_date", "day"),
    ("dim_station", "latitude"), ("dim_station", "longitude"), ("dim_station", "elevation_m"), ("dim_station", "station_name"),
    ("mart_yearly_climate", "observation_year"), ("mart_yearly_climate", "station_count"),
    ("mart_yearly_climate", "tmax_days"), ("mart_yearly_climate", "station_days")]
_KEYS = [  # (table, column, set of keys, whether the table is the parent side)
    ("raw_stations", "id", "raw station", True), ("raw_observations", "id", "raw station", False),
    ("dim_station", "station_id", "station", True), ("fct_daily_weather", "station_id", "station", False),
    ("dim_date", "date_day", "day", True), ("fct_daily_weather", "observation_date", "day", False)]
_TMAX_TEST = "assert_tmax_not_below_tmin"
_SEASON_TEST = "accepted_values_dim_date_season"


def _entries(name: str, df: DataFrame) -> DataFrame:
    """(set, key, side) for each key and each violated row test of a table; sides are p(arent), c(hild) and v(iolation)."""
    entry = lambda group, key, side: F.struct(
        F.lit(group).alias("set"), key.cast("string").alias("key"), F.lit(side).alias("side"))
    when = lambda bad, test: F.when(bad, entry(test, F.lit(None), "v"))
    found = [entry(group, F.col(column), "p" if parent else "c") for table, column, group, parent in _KEYS if table == name]
    found += [when(F.col(column).isNull(), f"not_null_{name}_{column}") for table, column in _ROW_TESTS if table == name]
    if name == "fct_daily_weather":
        found.append(when(F.col("tmax_c") < F.col("tmin_c"), _TMAX_TEST))
    if name == "dim_date":
        unknown = F.col("season").isNotNull() & ~F.col("season").isin(list(SEASONS))
        found.append(F.when(unknown, entry(_SEASON_TEST, F.col("season"), "v")))
    return df.select(F.inline(F.array_compact(F.array(*found))))


def run_data_tests(
    raw_stations: DataFrame, raw_observations: DataFrame, dim_date: DataFrame, dim_station: DataFrame,
    fct: DataFrame, mart: DataFrame,
) -> DataFrame:
    """The declared test suite: one row per test (name, model, column, failures).

    Failures count null rows (not_null), duplicated key values (unique), orphan child rows
    (relationships), unaccepted distinct values (accepted_values) and violating rows
    (tmax below tmin). Each table is scanned once; one exchange, of rows counted per task by (set, key), serves all
    26 tests, so a hot key costs one record a task and a child never meets its parent row by row.
    """
    tables = {"raw_stations": raw_stations, "raw_observations": raw_observations, "dim_date": dim_date,
              "dim_station": dim_station, "fct_daily_weather": fct, "mart_yearly_climate": mart}
    entries = None
    for name, df in tables.items():
        entries = _entries(name, df) if entries is None else entries.unionByName(_entries(name, df))
    keys = entries.groupBy("set", "key").agg(*(F.count_if(F.col("side") == side).alias(side) for side in "pcv"))

    of = lambda group, x: F.coalesce(F.sum(F.when(F.col("set") == group, x)), F.lit(0)).cast("bigint")
    known = F.col("key").isNotNull()
    tests = []
    for table, column, group, parent in _KEYS:
        side = "p" if parent else "c"
        tests.append((f"not_null_{table}_{column}", table, column, of(group, F.when(~known, F.col(side)))))
        if parent:
            tests.append((f"unique_{table}_{column}", table, column, of(group, (known & (F.col("p") > 1)).cast("int"))))
        else:
            tests.append((f"relationships_{table}_{column}", table, column, of(group, F.when(known & (F.col("p") == 0), F.col("c")))))
    tests += [(f"not_null_{table}_{column}", table, column, of(f"not_null_{table}_{column}", F.col("v"))) for table, column in _ROW_TESTS]
    tests.append((_TMAX_TEST, "fct_daily_weather", "tmax_c", of(_TMAX_TEST, F.col("v"))))
    tests.append((_SEASON_TEST, "dim_date", "season", of(_SEASON_TEST, F.lit(1))))
    counted = keys.agg(*(failures.alias(name) for name, _, _, failures in tests))
    return counted.select(F.inline(F.array(*(
        F.struct(F.lit(name).alias("test_name"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                 F.col(name).alias("failures")) for name, model, column, _ in tests))))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Post-load row count of each named table, one row per table (model, rows)."""
    parts = [df.agg(F.lit(name).alias("model"), F.count("*").alias("rows")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- reconciliation and reruns ----------------------------------------------


def reconcile(
    left: DataFrame, right: DataFrame, key: str, measures: Sequence[str],
    left_name: str = "left", right_name: str = "right",
) -> DataFrame:
    """Full outer join on ``key``: each measure from both sides and their difference
    (left - right). A key present on one side only shows nulls on the other."""
    lsel = left.select(F.col(key).alias(key), *[F.col(m).alias(f"{left_name}_{m}") for m in measures])
    rsel = right.select(F.col(key).alias(key), *[F.col(m).alias(f"{right_name}_{m}") for m in measures])
    j = lsel.join(rsel, key, "full_outer")
    return j.select(
        key,
        *[
            c
            for m in measures
            for c in (
                F.col(f"{left_name}_{m}"),
                F.col(f"{right_name}_{m}"),
                (F.col(f"{left_name}_{m}") - F.col(f"{right_name}_{m}")).alias(f"diff_{m}"),
            )
        ],
    )


def rerun_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs between two runs: each distinct differing row
    once, with the side holding the surplus and how many ``copies`` more it holds
    (``EXCEPT ALL`` both ways, in counted form). Empty = identical outputs.

    One shuffle on the row values with a signed partial count, so a row repeated
    millions of times costs one record per task, never an expanded list.
    """
    cols = old.columns
    tagged = old.withColumn("__d", F.lit(1)).unionByName(new.select(*cols).withColumn("__d", F.lit(-1)))
    counted = tagged.groupBy(*cols).agg(F.sum("__d").alias("__d")).filter(F.col("__d") != 0)
    return counted.select(
        *cols,
        F.when(F.col("__d") > 0, F.lit("old_only")).otherwise(F.lit("new_only")).alias("side"),
        F.abs("__d").alias("copies"),
    )


# --- reruns, partition by partition ---------------------------------------------


def partition_checksums(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per partition its rows and two order-free checksums of their values (a repeated row counts each time): one
    scan, partial sums, a row a partition."""
    values = [F.col(c) for c in df.columns]
    total = lambda salt: F.sum(F.xxhash64(F.lit(salt), *values).cast("decimal(38,0)"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), total(0).alias("a"), total(1).alias("b"))


def differing_partitions(old: DataFrame, new: DataFrame, by: Sequence[str]) -> list[tuple]:
    """The partitions whose rows or checksums differ, or that one side lacks: at most as many as there are partitions."""
    other = {c: f"__other_{c}" for c in by}  # names of their own: both sides may be one table
    theirs = partition_checksums(new.select(*old.columns), by).select(
        *(F.col(c).alias(o) for c, o in other.items()), F.col("n").alias("n2"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    ours = partition_checksums(old, by)
    same = F.lit(True)
    for c, o in other.items():
        same = same & F.col(c).eqNullSafe(F.col(o))
    joined = ours.join(theirs, same, "full_outer")
    differs = ~(F.col("n").eqNullSafe(F.col("n2")) & F.col("a").eqNullSafe(F.col("a2")) & F.col("b").eqNullSafe(F.col("b2")))
    return [tuple(r) for r in joined.filter(differs).select(*(F.coalesce(c, o).alias(c) for c, o in other.items())).collect()]


def rerun_diff_by_partition(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """:func:`rerun_diff` of partitioned tables: only partitions whose checksums differ are read again and shuffled row by
    row (the filter on ``by`` prunes the others); equal ones cost a scan. ``by`` are the partition columns, never many values."""
    differing = differing_partitions(old, new, by)
    within = F.lit(False)
    for values in differing:
        one = F.lit(True)
        for c, v in zip(by, values):
            one = one & (F.col(c) == F.lit(v) if v is not None else F.col(c).isNull())
        within = within | one
    return rerun_diff(old.filter(within), new.select(*old.columns).filter(within))
