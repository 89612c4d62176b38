"""Parquet sinks. Each one returns the number of rows it wrote.

The rows are counted in the writing tasks themselves, after the last shuffle. There a task that
is run again after a failure is still counted once, and no second pass is needed.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F


# Seconds after a write until its shuffle can be dropped.
SETTLE_S = 2


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _writer(df: DataFrame, replace: str) -> DataFrameWriter:
    """`replace` is "all" for the whole dataset, "partitions" for the directories written to, "nothing" to add to what is there."""
    mode = {"all": "static", "partitions": "dynamic", "nothing": "static"}[replace]
    return df.write.mode("append" if replace == "nothing" else "overwrite").option("partitionOverwriteMode", mode)


def write_plain(df: DataFrame, path: str) -> int:
    """Replace the dataset at `path`; no shuffle, one file for each partition of `df`."""
    counted, seen = _counted(df)
    _writer(counted, "all").parquet(path)
    return seen.get["rows"]


def write_counted(
    df: DataFrame,
    path: str,
    keys: list[str],
    metrics: dict[str, Column] | None = None,
    hidden: list[str] | None = None,
    replace: str = "all",
    more: bool = False,
) -> dict[str, int]:
    """As `write_partitioned`, and count more than rows as they are written: each of `metrics`, an aggregate.

    Metrics may use columns in `hidden`, which are not stored. With `more` to come, the dataset is not marked as whole.
    """
    seen = Observation()
    every = {"rows": F.count(F.lit(1)), **(metrics or {})}
    counted = df.hint("rebalance", *keys).observe(seen, *[c.alias(name) for name, c in every.items()])
    writer = _writer(counted.drop(*(hidden or [])), replace)
    if more:
        writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    writer.partitionBy(*keys).parquet(path)
    return seen.get


def in_turns(turns: list[DataFrame], write: Callable[[DataFrame, str, bool], dict[str, int]]) -> dict[str, int]:
    """Write tables one after the other into one dataset; return the sums of the counts.

    `write` gets a table, what it replaces, and if more are to come. Before each turn the shuffles of earlier
    ones are dropped, so that those of one turn lie on disk at a time.
    """
    total: Counter[str] = Counter()
    for at, df in enumerate(turns):
        if at:
            # While its end is told to Spark's listeners, a write still holds its shuffle.
            time.sleep(SETTLE_S)
        drop_shuffles(df)
        total.update(write(df, "nothing" if at else "all", at + 1 < len(turns)))
    return dict(total)


def drop_shuffles(df: DataFrame) -> None:
    """Let Spark drop the shuffles that no plan needs any more: it does when the driver collects garbage, which it would seldom do of itself."""
    df.sparkSession._jvm.System.gc()


def write_partitioned(df: DataFrame, path: str, keys: list[str], replace: str = "all") -> int:
    """Replace the dataset at `path`, with one directory level for each of `keys`.

    Rows are rebalanced on the keys first: a small directory gets one file rather than one from
    each task. Adaptive execution cuts a large directory, even one with a third of all rows,
    into tasks of `spark.sql.adaptive.advisoryPartitionSizeInBytes`.
    """
    return write_counted(df, path, keys, replace=replace)["rows"]


def write_ranged(df: DataFrame, path: str, keys: list[str], files: int = 3) -> int:
    """Replace the dataset at `path` by up to `files` files holding ranges of `keys`.

    A hash of the row and its partition number are the last range keys, so that a hot key, or a
    group of equal rows, is divided over several files; only neighbouring files share a key. A
    task that runs again sends its rows the same way. Inside a file rows are sorted by `keys`, and it has
    a bloom filter of the first one: a lookup of a value reads few row groups, or none.
    """
    last = (F.xxhash64(*df.columns), F.spark_partition_id())
    spread = df.repartitionByRange(files, *[F.col(k) for k in keys], *last).sortWithinPartitions(*keys)
    counted, seen = _counted(spread)
    _writer(counted, "all").option(f"parquet.bloom.filter.enabled#{keys[0]}", "true").parquet(path)
    return seen.get["rows"]
