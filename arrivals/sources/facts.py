"""Arrival records: one row per traveller and arrival."""

from __future__ import annotations

from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from arrivals.schemas import FACTS, check_columns
from arrivals.sources.delimited import read_delimited


def read_facts(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType = FACTS, faulty: str | None = None) -> DataFrame:
    """Scan a typed extract, Parquet by preference: only the columns of `schema` are read.

    For CSV, which binds by position, `schema` must list all columns of the file, and the header is
    compared with it. Formats that carry a schema are checked first: an absent column or another type fails,
    others may be there. With `faulty`, a last column of that name tells if a record has a bad value or
    a wrong number of fields.
    """
    if fmt == "csv":
        rows = read_delimited(spark, path, schema, faulty=faulty)
        return rows.withColumn(faulty, F.col(faulty).isNotNull()) if faulty else rows
    check_columns(spark.read.format(fmt).load(path), schema)
    rows = spark.read.schema(schema).format(fmt).load(path)
    return rows.withColumn(faulty, F.lit(False)) if faulty else rows


def read_facts_untyped(spark: SparkSession, path: str, schema: StructType = FACTS, faulty: str | None = None) -> DataFrame:
    """Scan CSV files whose header gives the column names, in any order, among other columns.

    All files of a folder must have the same header; one that differs fails the read.

    All columns arrive as text. `count` is dropped and the columns of `schema` are picked by
    name and cast; text that is not a number becomes null. With `faulty`, a last column of that name
    tells if a record has such text.
    """
    text = check_columns(spark.read.csv(path, header=True, enforceSchema=False), schema, types=False).drop("count")
    numbers = [f for f in schema if not isinstance(f.dataType, StringType)]
    columns = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f in numbers else F.col(f.name) for f in schema]
    if faulty:
        bad = (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in numbers)
        columns.append(reduce(Column.__or__, bad, F.lit(False)).alias(faulty))
    return text.select(columns)


def by_files(facts: DataFrame, path: str, most_bytes: int) -> list[DataFrame]:
    """The rows read from `path` in parts, by whole files of up to `most_bytes` together, or one larger file.

    Each part reads its own files only. The parts are ranges of paths, so that every file belongs to one.
    """
    file = F.col("_metadata.file_path")
    # Nothing but names and sizes is read so, whatever the format.
    sizes = facts.sparkSession.read.format("binaryFile").load(path).select(file.alias("file"), F.col("_metadata.file_size").alias("bytes"))
    starts, held = [], 0
    for name, size in sorted(map(tuple, sizes.collect())):
        if held and held + size > most_bytes:
            starts.append(name)
            held = 0
        held += size
    if not starts:
        return [facts]
    within = lambda low, high: (F.lit(True) if low is None else file >= low) & (F.lit(True) if high is None else file < high)
    return [facts.filter(within(low, high)) for low, high in pairwise([None, *starts, None])]
