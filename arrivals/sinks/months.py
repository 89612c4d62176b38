"""Slices of a dataset, such as its months, published in several layouts at once.

A load writes all its slices as a new version, beside what is there: one job for each layout and turn, whatever the number
of slices. What is stored is then read back and counted, and only if all layouts agree is the version published:
one small file, appended to the list of publications, says which version of each of these slices is valid
from now on. Readers go through that list. So a load that is killed at any time leaves the earlier
version as it was, in every layout, and a load that is repeated replaces its slices whole.

Folders, for a dataset at `path`: `path_published` (the list), and `path<layout>/version=<id>/<slice>/...`.
One load at a time may publish to a dataset.
"""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arrivals.schemas import check_schema
from arrivals.sinks.parquet import in_turns, write_counted

PUBLICATIONS = "publication bigint, version string, slice string, rows bigint"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class IncompleteLoad(RuntimeError):
    """The layouts of a new version do not hold the same rows; it was not published."""


def _directory(keys: list[str]) -> Column:
    """The directories of a row's slice."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit(NO_VALUE))) for k in keys])


def _folder(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A path, and the file system that it is on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def publications(spark: SparkSession, path: str) -> DataFrame:
    """Every publication of every slice: publication, version, slice, rows."""
    listed, files = _folder(spark, f"{path}_published")
    if not files.exists(listed):
        return spark.createDataFrame([], PUBLICATIONS)
    return spark.read.schema(PUBLICATIONS).parquet(f"{path}_published")


def published(spark: SparkSession, path: str) -> dict[str, str]:
    """The valid version of each slice. Slices are few, such as months: they come to the driver."""
    last = F.max_by("version", "publication").alias("version")
    return {r["slice"]: r["version"] for r in publications(spark, path).groupBy("slice").agg(last).collect()}


def read_published(spark: SparkSession, path: str, layout: str, schema: StructType) -> DataFrame:
    """The valid versions of all slices, in one layout; only their directories are listed."""
    root = f"{path}{layout}"
    folders = [f"{root}/version={version}/{where}" for where, version in sorted(published(spark, path).items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).select(schema.names)


def check_stored(df: DataFrame, path: str, layouts: dict[str, list[str]]) -> None:
    """Fail if a valid version is stored with other columns than `df` has; the files say what they hold."""
    spark = df.sparkSession
    for version in sorted(set(published(spark, path).values())):
        for layout, keys in layouts.items():
            # A version was written by one load, so its files are alike.
            stored = spark.read.parquet(f"{path}{layout}/version={version}").drop(*keys)
            check_schema(df.drop(*keys), stored.schema)


def publish(
    df: DataFrame | list[DataFrame],
    path: str,
    layouts: dict[str, list[str]],
    slices: int,
    metrics: dict[str, Column] | None = None,
    hidden: list[str] | None = None,
) -> dict[str, int]:
    """Replace the slices that `df` has rows of, in all layouts, and leave all others; return what was counted.

    A layout is a list of directory columns, of which the first `slices`, the same in all, name the slice. `df` is
    computed once for each layout. `metrics` are counted as the first layout is written, besides `rows`;
    columns in `hidden` serve them and are not stored. Of a list, whose tables are alike, each table is
    written in a turn of its own (`in_turns`), and they are published together.
    """
    turns = df if isinstance(df, list) else [df]
    spark = turns[0].sparkSession
    hidden = hidden or []
    bare = turns[0].drop(*hidden)
    check_stored(bare, path, layouts)
    version = uuid.uuid4().hex
    counted: dict[str, int] = {}
    for layout, keys in layouts.items():
        some = {} if counted else metrics
        counts = in_turns(
            [t.drop(*hidden) for t in turns] if counted else turns,
            lambda t, *how, layout=layout, keys=keys, some=some: write_counted(t, f"{path}{layout}/version={version}", keys, some, hidden, *how),
        )
        counted = counted or counts
        if counts["rows"] != counted["rows"]:
            raise IncompleteLoad(f"the layouts hold {counted['rows']} and {counts['rows']} rows: the source changed in between")
    stored: dict[str, list[int]] = {}
    for at, (layout, keys) in enumerate(layouts.items()):
        where = _directory(keys[:slices]).alias("slice")
        files = spark.read.schema(bare.schema).parquet(f"{path}{layout}/version={version}")
        for r in files.groupBy(where).agg(F.count(F.lit(1)).alias("rows")).collect():
            stored.setdefault(r["slice"], [0] * len(layouts))[at] = r["rows"]
    if any(len(set(rows)) > 1 for rows in stored.values()) or sum(rows[0] for rows in stored.values()) != counted["rows"]:
        raise IncompleteLoad(f"{counted['rows']} rows were written, and stored are {stored}")
    if stored:
        number = (publications(spark, path).agg(F.max("publication")).first()[0] or 0) + 1
        rows = [(number, version, where, counts[0]) for where, counts in sorted(stored.items())]
        # One file: it is there whole, or not at all.
        spark.createDataFrame(rows, PUBLICATIONS).coalesce(1).write.mode("append").parquet(f"{path}_published")
    return counted


def remove_replaced(spark: SparkSession, path: str, layouts: dict[str, list[str]]) -> list[str]:
    """Delete the versions of which no slice is valid any more, and what killed loads left; return them.

    Not while a load is running. A reader that began with an earlier publication may miss its files.
    """
    valid = set(published(spark, path).values())
    removed = set()
    for layout in layouts:
        root, files = _folder(spark, f"{path}{layout}")
        for entry in files.listStatus(root) if files.exists(root) else []:
            name = entry.getPath().getName()
            if name.startswith("version=") and name.removeprefix("version=") not in valid:
                files.delete(entry.getPath(), True)
                removed.add(name.removeprefix("version="))
    return sorted(removed)
