"""Airports, demographics, duplicates, counts and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.catalog import standins as s
from arrivals.functions import nth_part
from arrivals.operators import dedup, distinct_rows, union_codes
from arrivals.plans import clean_airports, clean_demographics
from arrivals.quality import preview, row_counts


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def airport_filter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country filter, region and coordinate parts; short or malformed text gives null."""
    airports = s.derive(spark, sf_dir, s.AIRPORTS_RAW).filter(F.col("iso_country") == "US")
    coordinates = F.col("coordinates")
    return airports.select(
        "airport_id",
        "gps_code",
        nth_part(F.col("iso_region"), "-", 1).alias("state"),
        nth_part(coordinates, ",", 0).try_cast("double").alias("latitude"),
        nth_part(coordinates, ",", 1).try_cast("double").alias("longitude"),
    )


def code_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    airports = s.derive(spark, sf_dir, s.AIRPORTS_RAW).select("airport_id", "type", "iata_code", "local_code")
    return union_codes(airports, ["iata_code", "local_code"], "airport_code")


def airports_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_airports(s.derive(spark, sf_dir, s.AIRPORTS_RAW))


def demographics_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_demographics(s.derive(spark, sf_dir, s.DEMOGRAPHICS))


def distinct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(_read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


def distinct_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(s.derive(spark, sf_dir, s.AIRPORTS_RAW))


def dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line of the lowest order of each (supplier, return flag)."""
    lines = _read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return dedup(lines, ["l_suppkey", "l_returnflag"], ["l_orderkey", "l_linenumber"])


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = s.derive(spark, sf_dir, s.DEMOGRAPHICS)
    airports = s.derive(spark, sf_dir, s.AIRPORTS_RAW)
    lines = _read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return row_counts(
        {
            "airports": (distinct_rows(airports), clean_airports(airports)),
            "demographics": (orders, clean_demographics(orders)),
            "lines": (lines, distinct_rows(lines)),
        }
    )


def preview_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return preview(orders, ["o_orderkey"])


QUERIES = {
    "airport_filter_split": airport_filter_split,
    "code_union": code_union,
    "airports_clean": airports_clean,
    "demographics_clean": demographics_clean,
    "distinct_rows": distinct_lines,
    "distinct_airports": distinct_airports,
    "dedup_subset": dedup_subset,
    "quality_report": quality_report,
    "preview": preview_orders,
}

_AIRPORTS_RAW = s.plain(s.AIRPORTS_RAW)

_SPLIT = f"""
    SELECT *, string_split(iso_region, '-')[2] AS state,
        TRY_CAST(string_split(coordinates, ',')[1] AS DOUBLE) AS latitude,
        TRY_CAST(trim(string_split(coordinates, ',')[2]) AS DOUBLE) AS longitude
    FROM ({_AIRPORTS_RAW}) AS raw WHERE iso_country = 'US'
"""


def _airports_by(code: str) -> str:
    return f"""
        SELECT airport_id, type, name, elevation_ft, iso_country, state, municipality, gps_code,
            {code} AS airport_code, latitude, longitude
        FROM ({_SPLIT}) AS split WHERE {code} IS NOT NULL
    """


AIRPORTS_SQL = f"{_airports_by('iata_code')} UNION {_airports_by('local_code')}"

DEMOGRAPHICS_SQL = f"""
    SELECT * EXCLUDE (rank) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY state, city, race
            ORDER BY median_age NULLS FIRST, male_population NULLS FIRST, female_population NULLS FIRST,
                total_population NULLS FIRST, number_of_veterans NULLS FIRST, number_of_foreign_born NULLS FIRST,
                average_household_size NULLS FIRST, state_code NULLS FIRST, count NULLS FIRST) AS rank
        FROM ({s.plain(s.DEMOGRAPHICS)}) AS raw WHERE state IS NOT NULL) AS ranked
    WHERE rank = 1
"""

SQL = {
    "airport_filter_split": f"SELECT airport_id, gps_code, state, latitude, longitude FROM ({_SPLIT}) AS s",
    "code_union": f"""
        SELECT airport_id, type, iata_code AS airport_code FROM ({_AIRPORTS_RAW}) AS a WHERE iata_code IS NOT NULL
        UNION
        SELECT airport_id, type, local_code AS airport_code FROM ({_AIRPORTS_RAW}) AS b WHERE local_code IS NOT NULL
    """,
    "airports_clean": AIRPORTS_SQL,
    "demographics_clean": DEMOGRAPHICS_SQL,
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "distinct_airports": f"SELECT DISTINCT * FROM ({_AIRPORTS_RAW}) AS a",
    "dedup_subset": """
        SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
        FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag
              ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS rank FROM lineitem) AS r
        WHERE rank = 1
    """,
    "quality_report": f"""
        SELECT 'airports' AS dataset, (SELECT count(*) FROM (SELECT DISTINCT * FROM ({_AIRPORTS_RAW}) AS r) AS d)
            AS rows_in, (SELECT count(*) FROM ({AIRPORTS_SQL}) AS a) AS rows_out
        UNION ALL
        SELECT 'demographics', (SELECT count(*) FROM orders), (SELECT count(*) FROM ({DEMOGRAPHICS_SQL}) AS d)
        UNION ALL
        SELECT 'lines', count(*),
            (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem) AS d)
        FROM lineitem
    """,
    "preview": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5
    """,
}
