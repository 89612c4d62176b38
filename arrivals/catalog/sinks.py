"""Sinks: each query stores a whole result and reads it back with its declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.catalog import standins as s
from arrivals.catalog.mappings import SQL as MAPPING_SQL
from arrivals.catalog.mappings import map_port
from arrivals.catalog.star import ARRIVALS_SQL, arrivals
from arrivals.catalog.tables import AIRPORTS_SQL, DEMOGRAPHICS_SQL, airports_clean, demographics_clean
from arrivals.plans.airports import RANGE_KEYS
from arrivals.plans.arrivals import MODE_LAYOUT, MONTH_KEYS, STATE_LAYOUT
from arrivals.plans.demographics import LAYOUT
from arrivals.schemas import AIRPORTS, ARRIVALS, DEMOGRAPHICS, US_PORTS
from arrivals.sinks import publish, read_published, write_partitioned, write_plain, write_ranged
from arrivals.sources import read_stored


def sink_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = s.scratch(spark, "us_ports")
    write_plain(map_port(spark, sf_dir), path)
    return read_stored(spark, path, US_PORTS)


def sink_partition3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = s.scratch(spark, "arrivals_us_state")
    write_partitioned(arrivals(spark, sf_dir), path, STATE_LAYOUT)
    return read_stored(spark, path, ARRIVALS)


def sink_partition4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = s.scratch(spark, "arrivals_arrival_mode")
    write_partitioned(arrivals(spark, sf_dir), path, MODE_LAYOUT)
    return read_stored(spark, path, ARRIVALS)


def sink_month_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months, with other states and ports, then all again: nothing of the first load is left."""
    path = s.scratch(spark, "arrivals_months")
    facts = arrivals(spark, sf_dir)
    layouts = {"_us_state": STATE_LAYOUT}
    publish(facts.withColumn("us_state", F.concat("us_state", F.lit("x"))), path, layouts, MONTH_KEYS)
    publish(facts, path, layouts, MONTH_KEYS)
    return read_published(spark, path, "_us_state", ARRIVALS)


def sink_partition1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = s.scratch(spark, "demographics")
    write_partitioned(demographics_clean(spark, sf_dir), path, LAYOUT)
    return read_stored(spark, path, DEMOGRAPHICS)


def sink_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = s.scratch(spark, "us_airports")
    write_ranged(airports_clean(spark, sf_dir), path, RANGE_KEYS)
    return read_stored(spark, path, AIRPORTS)


QUERIES = {
    "sink_plain": sink_plain,
    "sink_partition3": sink_partition3,
    "sink_partition4": sink_partition4,
    "sink_month_replaced": sink_month_replaced,
    "sink_partition1": sink_partition1,
    "sink_range": sink_range,
}

SQL = {
    "sink_plain": MAPPING_SQL["map_port"],
    "sink_partition3": ARRIVALS_SQL,
    "sink_partition4": ARRIVALS_SQL,
    "sink_month_replaced": ARRIVALS_SQL,
    "sink_partition1": DEMOGRAPHICS_SQL,
    "sink_range": AIRPORTS_SQL,
}
