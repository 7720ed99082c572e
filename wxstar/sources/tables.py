"""Adapters: observation-shaped inputs derived by Spark from the driver's test tables.

No weather data ships with the test tables, so the same pipeline runs on rows derived
from them; the work grows with the tables:

* a **station** is a supplier; its country code comes from its nation key, its metadata
  from the supplier row;
* an **observation** is a lineitem: station = its supplier, date = ship date,
  element = line number, value = quantity and discount.

The rules below are fixed and also written out in the oracle SQL of ``__spark_entry__``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the adapters.
# ---------------------------------------------------------------------------
# Element of a lineitem by its line number 1..7; 7 maps to an element outside the core six.
LINE_ELEMENTS = ["TMAX", "TMIN", "PRCP", "TAVG", "SNOW", "SNWD", "WT01"]
# Province / territory codes, handed out by account-balance band (850 wide from -1000).
PROVINCES = ["AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT"]
# Country code of a nation, by nation key 0..24: the nations of the TPC-H specification in
# key order, written as FIPS 10-4 two-letter codes (the station ids' country prefix).
# Key 3 (Canada) is "CA"; key 24 (United States) is "US".
NATION_CODES = [
    "AG", "AR", "BR", "CA", "EG", "ET", "FR", "GM", "IN", "ID", "IR", "IZ", "JA",
    "JO", "KE", "MO", "MZ", "PE", "CH", "RO", "SA", "VM", "RS", "UK", "US",
]
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _country_code() -> Column:
    """Country code straight from the supplier's nation key (a fixed lookup, so no join
    with ``nation`` is needed: Spark then sizes the supplier side from its own file)."""
    return F.try_element_at(F.array(*[F.lit(c) for c in NATION_CODES]), F.col("s_nationkey") + 1)


def _station_id() -> Column:
    key = F.col("s_suppkey").cast("string")
    # lpad would cut a wider key, and two stations could share an id
    wide = F.raise_error(F.lit("supplier key does not fit the 9 digits of a station id"))
    return F.concat(_country_code(), F.when(F.length(key) <= 9, F.lpad(key, 9, "0")).otherwise(wide))


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier: key, station id and the text fields of a station record."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    bal = F.col("s_acctbal")
    return sup.select(
        "s_suppkey",
        _station_id().alias("id"),
        (F.lit(42) + bal / 1000).cast("decimal(8,5)").cast("string").alias("latitude"),
        (F.lit(-60) - bal / 1000).cast("decimal(8,5)").cast("string").alias("longitude"),
        F.floor(bal / 10).cast("string").alias("elevation"),
        F.try_element_at(
            F.array(*[F.lit(p) for p in PROVINCES]),
            F.least(F.floor((bal + 1000) / 850).cast("int") + 1, F.lit(len(PROVINCES))),
        ).alias("state"),
        F.col("s_name").alias("name"),
        F.when(bal > 9000, F.lit("GSN")).otherwise(F.lit("")).alias("gsn_flag"),
        F.when(bal.between(0, 1000), F.lit("HCN")).otherwise(F.lit("")).alias("hcn_crn_flag"),
        # the field holds five digits; stations beyond have no WMO id rather than a cut one
        F.when((bal >= 0) & (F.col("s_suppkey") < 100_000), F.lpad(F.col("s_suppkey").cast("string"), 5, "0"))
        .otherwise(F.lit(""))
        .alias("wmo_id"),
    )


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations as fixed-width text lines (column ``value``), trailing blanks cut, so a
    station without WMO id gives a line shorter than the layout."""
    s = supplier_stations(spark, sf_dir)
    line = F.concat(
        F.rpad("id", 11, " "), F.lit(" "),
        F.lpad("latitude", 8, " "), F.lit(" "),
        F.lpad("longitude", 9, " "), F.lit(" "),
        F.lpad("elevation", 6, " "), F.lit(" "),
        F.rpad("state", 2, " "), F.lit(" "),
        F.rpad("name", 30, " "), F.lit(" "),
        F.rpad("gsn_flag", 3, " "), F.lit(" "),
        F.rpad("hcn_crn_flag", 3, " "), F.lit(" "),
        F.rpad("wmo_id", 5, " "),
    )
    return s.select(F.rtrim(line).alias("value"))


def _element() -> Column:
    return F.try_element_at(F.array(*[F.lit(e) for e in LINE_ELEMENTS]), F.col("l_linenumber"))


def long_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw long observations (all text, like the headerless CSV) plus ``src_order``, the
    position of the row in its source, used to resolve repeated (id, date, element) keys.

    Planted data issues, all by fixed rules on the lineitem:
    discount 0.10 and tax 0.00 -> impossible date (day 30 of February);
    discount 0.00 and tax 0.08 -> non-numeric value ``n/a``;
    return flag R and tax 0.08 -> quality flag ``X``; return flag A and tax 0.00 -> blank flag.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    st = supplier_stations(spark, sf_dir).select("s_suppkey", "id")
    disc, tax, rflag = F.col("l_discount"), F.col("l_tax"), F.col("l_returnflag")
    value = (
        F.col("l_quantity").cast("int") * 10 - 250 + F.round(disc * 100).cast("int")
    ).cast("string")
    return li.join(st, li.l_suppkey == st.s_suppkey).select(
        "id",
        F.when((disc == 0.10) & (tax == 0.0), F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("0230")))
        .otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
        .alias("date"),
        _element().alias("element"),
        F.when((disc == 0.0) & (tax == 0.08), F.lit("n/a")).otherwise(value).alias("data_value"),
        F.lit(None).cast("string").alias("m_flag"),
        F.when((rflag == "R") & (tax == 0.08), F.lit("X"))
        .when((rflag == "A") & (tax == 0.0), F.lit(""))
        .otherwise(F.lit(None).cast("string"))
        .alias("q_flag"),
        F.col("l_linestatus").alias("s_flag"),
        F.when(rflag == "N", F.date_format("l_shipdate", "HHmm")).alias("obs_time"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("src_order"),
    )


def inventory_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station inventory as fixed-width lines: first and last year of every
    (station, element) pair, aggregated from the lineitems before the supplier join."""
    li = table(spark, sf_dir, "lineitem")
    spans = li.groupBy("l_suppkey", _element().alias("element")).agg(
        F.min(F.year("l_shipdate")).alias("first_year"),
        F.max(F.year("l_shipdate")).alias("last_year"),
    )
    st = supplier_stations(spark, sf_dir).select("s_suppkey", "id", "latitude", "longitude")
    line = F.concat(
        F.rpad("id", 11, " "), F.lit(" "),
        F.lpad("latitude", 8, " "), F.lit(" "),
        F.lpad("longitude", 9, " "), F.lit(" "),
        F.rpad("element", 4, " "), F.lit(" "),
        F.col("first_year").cast("string"), F.lit(" "),
        F.col("last_year").cast("string"),
    )
    return spans.join(st, spans.l_suppkey == st.s_suppkey).select(line.alias("value"))
