"""Headerless code lists: one `code<separator>label` pair per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.functions import nth_part, trim_blank_edges, trim_leading_spaces


def read_mapping_lines(spark: SparkSession, path: str) -> DataFrame:
    """Scan a text file into one `value` column."""
    return spark.read.text(path)


def split_mapping_lines(lines: DataFrame, separator: str) -> DataFrame:
    """Split the `value` lines into text columns `code` and `label` at the first separator.

    A separator of several characters goes with lines trimmed at both ends. With a single
    character only the spaces before each field are removed: tabs and trailing blanks stay.
    Blank lines and a closing `;` hold no pair and are left out; `unpaired_lines` finds any others.
    """
    several = len(separator) > 1
    line = trim_blank_edges(F.col("value")) if several else F.col("value")
    field = (lambda c: c) if several else trim_leading_spaces
    return (
        lines.select(line.alias("line"))
        .filter(F.col("line").contains(separator))
        .select(
            field(nth_part(F.col("line"), separator, 0, limit=2)).alias("code"),
            field(nth_part(F.col("line"), separator, 1, limit=2)).alias("label"),
        )
    )


def unpaired_lines(lines: DataFrame, separator: str) -> DataFrame:
    """Lines that hold no pair, other than blank ones and a lone `;`."""
    line = F.trim(F.regexp_replace("value", r"\s", " "))
    return lines.filter(~F.col("value").contains(separator) & ~line.isin("", ";"))
