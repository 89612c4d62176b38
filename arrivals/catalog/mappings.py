"""Code list cleaning over lines derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrivals.catalog import standins as s
from arrivals.operators import COUNTRY, MODE, US_PORT, US_STATE, VISA, clean_mapping


def map_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_mapping(s.derive(spark, sf_dir, s.COUNTRY_LINES), COUNTRY)


def map_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_mapping(s.derive(spark, sf_dir, s.STATE_LINES), US_STATE)


def map_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_mapping(s.derive(spark, sf_dir, s.PORT_LINES), US_PORT)


def map_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_mapping(s.derive(spark, sf_dir, s.VISA_LINES), VISA)


def map_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_mapping(s.derive(spark, sf_dir, s.VISA_LINES), MODE)


QUERIES = {
    "map_country": map_country,
    "map_state": map_state,
    "map_port": map_port,
    "map_plain": map_plain,
    "map_mode": map_mode,
}

SQL = {
    "map_country": """
        SELECT c_custkey AS country_code,
            CASE c_custkey % 5 WHEN 3 THEN 'X Other' WHEN 4 THEN c_name || ' ' ELSE 'Other' END AS country
        FROM customer
    """,
    "map_state": """
        SELECT 'K' || CAST(s_suppkey AS VARCHAR) AS state_code, s_name || ' ' AS state FROM supplier
    """,
    "map_port": """
        SELECT CAST(c_custkey AS VARCHAR) || CASE c_custkey % 7 WHEN 0 THEN chr(9) WHEN 1 THEN ' ' ELSE '' END
                AS port_code,
            c_mktsegment || CASE c_custkey % 5 WHEN 2 THEN ',TX   ' WHEN 3 THEN ' ONEIL' ELSE '' END AS city,
            CASE c_custkey % 5 WHEN 0 THEN 'ST' WHEN 1 THEN 'PIER 9, NY' WHEN 3 THEN 'CA' END AS state
        FROM customer
    """,
    "map_plain": "SELECT p_partkey AS visa_code, p_name AS visa FROM part",
    "map_mode": "SELECT p_partkey AS mode_code, p_name AS mode FROM part",
}
