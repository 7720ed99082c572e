"""Column -> Column helpers built only from Spark's built-in functions (JVM side, codegen)."""

from wxstar.functions.scalar import (  # noqa: F401
    blank_to_null,
    country_of,
    decade_of,
    in_country,
    month_text,
    parse_obs_date,
    pct,
    season_of,
    to_double,
    to_int,
    year_from_path,
    year_window,
)
