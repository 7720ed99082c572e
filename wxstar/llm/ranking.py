"""Numbers rows in order within groups, however large one group is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxstar.llm.common import materialize

RANK, TOTAL = "__rank", "__total"
PART, AT = "__part", "__at"


def sorted_rows(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` sorted by ``keys`` over range partitions and written once, with ``__part`` (the ordered number of
    the partition) and ``__at`` (the row's place in it). Groups are cut wherever a partition ends.

    Both numbers are written with the rows, so a later reader sees the same ones whatever tasks are run again."""
    number = F.monotonically_increasing_id()
    return materialize(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumns({PART: F.shiftright(number, 33), AT: number.bitwiseAND(F.lit((1 << 33) - 1))}), name)


def ranked(df: DataFrame, group: str, keys: list[str], name: str) -> DataFrame:
    """Adds ``__rank``, the row's number from 0 among the rows of its ``group`` (not null) in the order of ``keys``, and
    ``__total``, the number of these rows.

    Each partition counts its rows of each group; a running sum over a group's partitions (at most one row a
    partition) gives the rank of the first, and a row's place in its partition the rest.
    """
    rows = sorted_rows(df, [group, *keys], name)
    runs = rows.groupBy(group, PART).agg(F.count(F.lit(1)).alias("__n"), F.min(AT).alias("__first"))
    whole = Window.partitionBy(group)
    before = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        group, PART, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(whole).alias(TOTAL))
    return rows.join(starts, [group, PART]).withColumn(RANK, F.col(AT) + F.col("__shift")).drop(PART, AT, "__shift")
