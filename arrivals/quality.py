"""Row counts and previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

REPORT = StructType(
    [
        StructField("dataset", StringType()),
        StructField("rows_in", LongType()),
        StructField("rows_out", LongType()),
    ]
)


def preview(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order. Each task keeps `rows` rows; there is no full sort."""
    return df.orderBy(*order).limit(rows)


def count_rows(df: DataFrame) -> DataFrame:
    """One row with the number of rows; for Parquet this reads file footers only."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def count_distinct(df: DataFrame) -> int:
    """The number of distinct rows, told apart by SHA-256 of their values: only digests are shuffled."""
    # A value is preceded by its length, so that neither nulls nor separators make unlike rows alike.
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (F.col(n).cast("string") for n in df.columns)]
    return count_rows(df.select(F.unhex(F.sha2(F.concat(*parts), 256)).alias("digest")).distinct()).first()["rows"]


def row_counts(steps: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows before and after each named step, as one lazy DataFrame."""
    none = F.lit(0).cast("bigint")
    counts = []
    for name, (before, after) in steps.items():
        dataset = F.lit(name).alias("dataset")
        counts.append(count_rows(before).select(dataset, F.col("rows").alias("rows_in"), none.alias("rows_out")))
        counts.append(count_rows(after).select(dataset, none.alias("rows_in"), F.col("rows").alias("rows_out")))
    return (
        reduce(DataFrame.unionByName, counts)
        .groupBy("dataset")
        .agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))
    )


def report(spark: SparkSession, counts: list[tuple[str, int, int]]) -> DataFrame:
    """Counts taken while storing, one row for each dataset."""
    return spark.createDataFrame(counts, REPORT)
