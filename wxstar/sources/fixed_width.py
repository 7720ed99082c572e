"""Fixed-width text -> typed-as-string columns, driven by a (name, start, end) layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Layout = list[tuple[str, int, int]]


def parse_fixed_width(
    lines: DataFrame, layout: Layout, blank_as_null: bool = True, value_col: str = "value"
) -> DataFrame:
    """Cut each line into the layout's fields and trim them.

    ``start``/``end`` are 1-based and inclusive. A line shorter than a field yields ``''``
    for it (Spark's ``substring`` past the end), which ``blank_as_null`` turns into null;
    with ``blank_as_null=False`` blanks stay ``''`` (the profiling variant).
    """
    cols = []
    for name, start, end in layout:
        field = F.trim(F.substring(F.col(value_col), start, end - start + 1))
        if blank_as_null:
            field = F.nullif(field, F.lit(""))
        cols.append(field.alias(name))
    return lines.select(*cols)


def read_fixed_width(
    spark: SparkSession, path: str | list[str], layout: Layout, blank_as_null: bool = True
) -> DataFrame:
    """``spark.read.text`` + :func:`parse_fixed_width`. Plain text splits, so a large file
    is read by many tasks."""
    return parse_fixed_width(spark.read.text(path), layout, blank_as_null)
