"""Scalar expressions (Column -> Column).

All of these are built-in Spark expressions, so they stay inside whole-stage codegen.
Casts use the ``try_`` forms: Spark 4 runs with ANSI mode on, where a plain ``cast``
of a malformed value raises instead of returning null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wxstar.schemas import DEFAULT_COUNTRY


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def country_of(station_id: str | Column = "id") -> Column:
    """Two-letter country code = first two characters of the station id (1-based substring)."""
    return F.substring(_col(station_id), 1, 2)


def in_country(country: str = DEFAULT_COUNTRY, station_id: str | Column = "id") -> Column:
    """Country-prefix predicate.

    Written as ``startswith`` rather than ``substring(id,1,2) = 'CA'``: the result is the
    same, but only the prefix form is pushed into the Parquet scan (``StringStartsWith``).
    """
    return _col(station_id).startswith(country)


def blank_to_null(c: str | Column) -> Column:
    """Trim and turn an empty string into null (quoted-empty and bare fields alike)."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def parse_obs_date(c: str | Column = "date") -> Column:
    """``yyyyMMdd`` text -> date; an impossible date (e.g. 20240230) gives null, no error."""
    return F.try_to_date(_col(c), "yyyyMMdd")


def to_int(c: str | Column) -> Column:
    """Text -> int; non-numeric text gives null instead of an ANSI cast error."""
    return _col(c).try_cast("int")


def to_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def month_text(date_col: str | Column = "date") -> Column:
    """Month as two-digit text, the form used for the ``month=MM`` partition directories."""
    return F.date_format(_col(date_col), "MM")


def season_of(month: str | Column) -> Column:
    """3-5 spring, 6-8 summer, 9-11 fall, otherwise (including null) winter."""
    m = _col(month)
    return (
        F.when(m.between(3, 5), F.lit("spring"))
        .when(m.between(6, 8), F.lit("summer"))
        .when(m.between(9, 11), F.lit("fall"))
        .otherwise(F.lit("winter"))
    )


def decade_of(year: str | Column) -> Column:
    """Decade of a year as int: 1999 -> 1990."""
    return (F.floor(_col(year) / 10) * 10).cast("int")


def pct(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """100 * part / whole rounded (HALF_UP); null instead of an error when whole is 0."""
    return F.round(F.try_divide(_col(part) * F.lit(100.0), _col(whole)), digits)


def year_from_path(path: str | Column) -> Column:
    """First four-digit run in the file name of ``path`` as int; fails the task if none.

    The file name is taken after the last ``/`` so a year in a directory name is ignored.
    """
    name = F.substring_index(_col(path), "/", -1)
    digits = F.regexp_extract(name, r"(\d{4})", 1)
    return F.when(digits != "", digits.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("cannot infer year from file name: "), name))
    )


def year_in_path(path: str | Column) -> Column:
    """First four-digit run in the file name as int, or null (no error) if there is none."""
    name = F.substring_index(_col(path), "/", -1)
    digits = F.regexp_extract(name, r"(\d{4})", 1)
    return F.when(digits != "", digits.cast("int"))


def year_window(ts: str | Column, years: int = 2) -> Column:
    """Array of the ``years`` years ending in the year of ``ts``: [Y-1, Y] by default."""
    y = F.year(_col(ts))
    return F.sequence(y - F.lit(years - 1), y)
