"""Code list file to dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrivals.operators import MappingSpec, clean_mapping
from arrivals.sources import read_mapping_lines, unpaired_lines


class BadCodeList(ValueError):
    """A code list has lines that are no pair, or no codes."""


def load_mapping(spark: SparkSession, path: str, spec: MappingSpec) -> DataFrame:
    """The cleaned list at `path`; fails if it has lines that are no pair."""
    lines = read_mapping_lines(spark, path)
    unpaired = unpaired_lines(lines, spec.separator).count()
    if unpaired:
        raise BadCodeList(f"{path}: {unpaired} lines without {spec.separator!r}")
    return clean_mapping(lines, spec)
