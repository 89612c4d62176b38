"""Sources: each query writes a stand-in in the source format and scans it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.catalog import standins as s
from arrivals.catalog.star import arrivals_sql, dimensions
from arrivals.operators import COUNTRY
from arrivals.plans import conform_arrivals
from arrivals.schemas import DEMOGRAPHICS
from arrivals.sources import (
    faulty_lines,
    read_airports,
    read_demographics,
    read_facts,
    read_facts_untyped,
    read_mapping_lines,
    split_mapping_lines,
)


def scan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed Parquet scan; surplus columns of the file are not read."""
    path = s.scratch(spark, "facts")
    facts = s.derive(spark, sf_dir, s.FACTS)
    facts.withColumns({"count": F.lit(1.0), "gender": F.lit("X")}).write.parquet(path)
    return read_facts(spark, path)


def scan_csv_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV of text columns bound by name; some ages are no numbers."""
    path = s.scratch(spark, "facts.csv")
    facts = s.derive(spark, sf_dir, s.FACTS)
    age = F.when(F.col("admnum") % 6 == 0, "unknown").otherwise(F.col("i94bir").cast("string"))
    facts.select(F.lit(7).alias("cicid"), F.lit(1).alias("count"), "*").withColumn("i94bir", age).write.csv(
        path, header=True
    )
    return read_facts_untyped(spark, path)


def scan_csv_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = s.scratch(spark, "airports.csv")
    s.derive(spark, sf_dir, s.AIRPORTS_RAW).write.csv(path, header=True)
    return read_airports(spark, path)


def scan_csv_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = s.scratch(spark, "demographics.csv")
    s.derive(spark, sf_dir, s.DEMOGRAPHICS_TEXT).write.csv(path, header=True, sep=";")
    return read_demographics(spark, path)


def scan_csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a bad number, or with fields cut off, as they stand in the files."""
    path = s.scratch(spark, "demographics_short.csv")
    lines = s.derive(spark, sf_dir, s.DEMOGRAPHICS_LINES)
    # One column, named like the whole header, with whole lines in it.
    lines.select(F.col("value").alias(";".join(DEMOGRAPHICS.names))).write.csv(path, header=True, sep="\x01", quote="")
    return faulty_lines(spark, path, DEMOGRAPHICS, ";").select("line", "empty_columns")


def arrivals_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts as text, conformed: columns bind by name, and ages that are no numbers become null."""
    return conform_arrivals(scan_csv_untyped(spark, sf_dir), dimensions(spark, sf_dir))


def scan_mapping_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = s.scratch(spark, "countries.txt")
    s.derive(spark, sf_dir, s.COUNTRY_LINES).write.text(path)
    return split_mapping_lines(read_mapping_lines(spark, path), COUNTRY.separator)


QUERIES = {
    "scan_facts": scan_facts,
    "scan_csv_untyped": scan_csv_untyped,
    "scan_csv_comma": scan_csv_comma,
    "scan_csv_semicolon": scan_csv_semicolon,
    "scan_csv_rejected": scan_csv_rejected,
    "scan_mapping_text": scan_mapping_text,
    "arrivals_from_csv": arrivals_from_csv,
}

_UNTYPED = f"""
    SELECT * REPLACE (CASE WHEN admnum % 6 = 0 THEN NULL ELSE i94bir END AS i94bir)
    FROM ({s.plain(s.FACTS)}) AS f
"""

SQL = {
    "scan_facts": s.plain(s.FACTS),
    "scan_csv_untyped": _UNTYPED,
    "arrivals_from_csv": arrivals_sql(_UNTYPED),
    "scan_csv_rejected": f"""
        SELECT value AS line, substr(empty_columns, 2) AS empty_columns
        FROM ({s.plain(s.DEMOGRAPHICS_LINES)}) AS t WHERE faulty
    """,
    "scan_csv_comma": s.plain(s.AIRPORTS_RAW),
    "scan_csv_semicolon": s.plain(s.DEMOGRAPHICS),
    "scan_mapping_text": f"""
        SELECT substr(line, 1, strpos(line, ' =  ') - 1) AS code, substr(line, strpos(line, ' =  ') + 4) AS label
        FROM (SELECT trim(value) AS line FROM ({s.plain(s.COUNTRY_LINES)}) AS t) AS u
    """,
}
