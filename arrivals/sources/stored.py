"""Datasets written by this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a Parquet dataset back with its declared schema and column order.

    The schema also covers the directory columns, so a port code like `060` stays text. Filters
    on directory columns prune whole directories.
    """
    return spark.read.schema(schema).parquet(path).select(schema.names)
