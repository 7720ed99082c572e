"""Long observations -> quality split -> one wide row per station and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxstar.functions.scalar import blank_to_null, in_country, month_text, parse_obs_date, to_int
from wxstar.schemas import CORE_ELEMENTS, DEFAULT_COUNTRY, SCALE, element_column

_RAW = ["id", "date", "element", "data_value", "m_flag", "q_flag", "s_flag", "obs_time"]


def scope_filter(country: str = DEFAULT_COUNTRY, elements: list[str] = CORE_ELEMENTS):
    """Country prefix AND element allow-list; both reach the scan as pushed filters."""
    return in_country(country) & F.col("element").isin(elements)


def prepare_observations(
    raw: DataFrame, country: str = DEFAULT_COUNTRY, elements: list[str] = CORE_ELEMENTS
) -> DataFrame:
    """Filter to the scope first (before anything is shuffled), then type the text columns.

    * ``date``: ``yyyyMMdd`` -> date, null if impossible;
    * ``data_value``: text -> int, null if non-numeric (the row survives);
    * ``q_flag``: trimmed, blank -> null, so a blank flag counts as clean;
    * ``year``/``month``: from the date; for an impossible date, from its text, and failing
      that from ``source_year`` (the file's year) when present, so the row still lands in
      its year's quarantine partition.
    Columns other than the eight raw ones (e.g. a source-order key) are kept.
    """
    d = parse_obs_date(F.col("date"))
    extra = [c for c in raw.columns if c not in _RAW and c != "source_year"]
    year_parts = [F.year(d), to_int(F.substring("date", 1, 4))]
    if "source_year" in raw.columns:  # the file's year, for date text without a usable year
        year_parts.append(F.col("source_year"))
    return raw.filter(scope_filter(country, elements)).select(
        "id",
        d.alias("date"),
        "element",
        to_int("data_value").alias("data_value"),
        "m_flag",
        blank_to_null("q_flag").alias("q_flag"),
        "s_flag",
        "obs_time",
        *extra,
        F.coalesce(*year_parts).alias("year"),
        F.coalesce(month_text(d), F.nullif(F.substring("date", 5, 2), F.lit(""))).alias("month"),
    )


def split_by_quality(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected). Clean = no quality flag and a valid date. Rejected rows carry a
    ``reason``: ``bad_date`` or ``q_flag``. The split precedes the pivot, so a station-day
    whose rows were all rejected produces no wide row."""
    bad_date = F.col("date").isNull()
    flagged = F.col("q_flag").isNotNull()
    clean = prepared.filter(~flagged & ~bad_date)
    rejected = prepared.filter(flagged | bad_date).withColumn(
        "reason", F.when(bad_date, F.lit("bad_date")).otherwise(F.lit("q_flag"))
    )
    return clean, rejected


def to_station_days(
    clean: DataFrame, order_key: str | None = None, elements: list[str] = CORE_ELEMENTS,
    keys: tuple[str, ...] = ("id", "date"),
) -> DataFrame:
    """Long -> wide by conditional aggregation: one ``groupBy`` on the station-day
    ``keys`` (id, date, plus columns that are functions of them), hence one exchange with
    map-side partial aggregation (``pivot()`` would plan two).

    A repeated (id, date, element) resolves deterministically: the value of the row with
    the smallest ``order_key`` (its position in the source), or the smallest value when no
    order key is given. A non-numeric value is a null cell; the station-day survives.
    """
    aggs = []
    for e in elements:
        is_e = F.col("element") == e
        if order_key:
            cell = F.min_by(F.col("data_value"), F.when(is_e, F.col(order_key)))
        else:
            cell = F.min(F.when(is_e, F.col("data_value")))
        aggs.append(cell.alias(element_column(e)))
    return clean.groupBy(*keys).agg(*aggs)


def scale_elements(wide: DataFrame, scale: dict[str, int] = SCALE) -> DataFrame:
    """Per-element units: elements in ``scale`` are divided (tenths -> units, double);
    the others keep their integer unit. A blanket /10 would be silently wrong for snow."""
    return wide.withColumns(
        {element_column(e): F.col(element_column(e)) / F.lit(d) for e, d in scale.items()
         if element_column(e) in wide.columns}
    )


def transform_observations(
    clean: DataFrame, order_key: str | None = None, elements: list[str] = CORE_ELEMENTS,
    scale: dict[str, int] = SCALE,
) -> DataFrame:
    """Pivot + scale + partition columns: id, date, <elements>, year, month.

    When the clean rows already carry ``year``/``month`` (as prepared rows do; both are
    functions of the date) they are carried through the grouping instead of recomputed,
    so a later filter on ``year`` (one year's replace) is a filter on a stored column of
    the input, which a cached or partitioned input can prune by.
    """
    if "year" in clean.columns and "month" in clean.columns:
        wide = to_station_days(clean, order_key, elements, keys=("id", "date", "year", "month"))
        cols = ["id", "date", *[element_column(e) for e in elements], "year", "month"]
        return scale_elements(wide, scale).select(*cols)
    wide = scale_elements(to_station_days(clean, order_key, elements), scale)
    return wide.withColumns({"year": F.year("date"), "month": month_text("date")})


def station_days_from_raw(
    raw: DataFrame, order_key: str | None = None, country: str = DEFAULT_COUNTRY,
    elements: list[str] = CORE_ELEMENTS,
) -> DataFrame:
    """prepare -> clean half of the split -> pivot -> scale, as one lazy plan."""
    clean, _ = split_by_quality(prepare_observations(raw, country, elements))
    return transform_observations(clean, order_key, elements)


def element_units(
    station_days: DataFrame, elements: list[str] = CORE_ELEMENTS, scale: dict[str, int] = SCALE
) -> DataFrame:
    """Unit audit of the wide rows: per element, its divisor, the number of filled cells
    and the sum of the stored values in whole tenths (exact). For a tenths element that
    sum equals the raw integer sum; for snow and snow depth, which are not divided, it is
    ten times the raw sum, so a blanket /10 shows up at once.

    One aggregate over the wide rows; only its one-row result is unpivoted.
    """
    cols = [element_column(e) for e in elements]
    agg = station_days.agg(
        *[x for c in cols for x in (F.count(c).alias(f"n_{c}"), F.sum(F.round(F.col(c) * 10).cast("bigint")).alias(f"s_{c}"))]
    )
    return agg.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("element"), F.lit(scale.get(e, 1)).alias("divisor"),
                        F.col(f"n_{c}").alias("cells"),
                        F.coalesce(F.col(f"s_{c}"), F.lit(0)).cast("bigint").alias("value_tenths"),
                    )
                    for e, c in zip(elements, cols)
                ]
            )
        )
    )
