"""CSV files with a header line and a declared schema."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from arrivals.schemas import AIRPORTS_RAW, DEMOGRAPHICS, SchemaMismatch


def _plain(name: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower())


def check_header(names: list[str], schema: StructType, path: str) -> None:
    """Fail unless a header can belong to `schema`.

    Files may call their columns as they like, but there must be as many, and a declared name, however
    spelled (`State Code`), must stand in its own place.
    """
    place = {f.name: i for i, f in enumerate(schema)}
    misplaced = [n for i, n in enumerate(names) if place.get(_plain(n), i) != i]
    if len(names) != len(schema) or misplaced:
        raise SchemaMismatch(f"{path}: {len(names)} columns for {len(schema)}, not in their places: {misplaced}")


def read_delimited(spark: SparkSession, path: str, schema: StructType, separator: str = ",", faulty: str | None = None) -> DataFrame:
    """Scan a CSV. Columns bind by position, bad values become null.

    The header is compared with `schema` (`check_header`), and every further file's with the first one's as it
    is read: one that differs fails the read. With `faulty`, a last column of that name has the line of a record
    with a bad value in a column that the query reads, or with too few or too many fields, and null for all others.
    """
    names = spark.read.csv(path, header=True, sep=separator).columns
    if names:
        check_header(names, schema, path)
    found = StructType([StructField(n, f.dataType) for n, f in zip(names or schema.names, schema, strict=True)])
    reader = spark.read.options(header=True, sep=separator, mode="PERMISSIVE", enforceSchema=not names)
    if faulty:
        # Fields are only counted if all columns are parsed.
        reader = reader.options(columnNameOfCorruptRecord=faulty, columnPruning=False)
        found = found.add(faulty, StringType())
    return reader.schema(found).csv(path).toDF(*schema.names, *([faulty] if faulty else []))


def faulty_lines(spark: SparkSession, path: str, schema: StructType, separator: str = ",") -> DataFrame:
    """Records with a bad value or a wrong number of fields: file, line, and the columns that are null in the table."""
    rows = read_delimited(spark, path, schema, separator, "__line")
    empty = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in schema.names]))
    # The scan does not give the line alone, so the columns are looked at for all lines.
    lines = rows.select(F.input_file_name().alias("file"), F.col("__line").alias("line"), F.array_join(empty, ",").alias("empty_columns"))
    return lines.filter(F.col("line").isNotNull())


def count_lines(spark: SparkSession, path: str, schema: StructType, separator: str = ",") -> tuple[int, int]:
    """The number of records, and of those `faulty_lines` finds, in one pass."""
    rows = read_delimited(spark, path, schema, separator, "__line")
    # A value is only read, and found to be bad, in a column that is asked for.
    counts = rows.agg(F.count(F.lit(1)), F.count("__line"), *[F.count(F.col(c)) for c in schema.names]).first()
    return counts[0], counts[1]


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, AIRPORTS_RAW)


def read_demographics(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, DEMOGRAPHICS, ";")
