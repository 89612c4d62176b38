"""Registered queries: every operator run over the verification tables, with its SQL.

The tables hold neither nulls nor dirty text. Each stand-in below derives an input of the star
schema from a whole table and adds both. It is written in SQL that Spark and the checking
database read alike, so that only the operators under test are expressed twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arrivals.catalog import mappings, scans, sinks, star, tables

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (scans, mappings, star, tables, sinks)


def all_queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
