"""What the operators on training documents share.

Identity: a document is a row. Rows that agree in `doc_id` and in `text` are repeats of one
document and are treated alike; a null `doc_id` sorts last. Columns other than the ones an
operator names are carried along untouched, whatever they are called.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The blanks that separate words, and the words, as the contracts spell them.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

# A key with at least this share of all rows is hot. There are at most 1/share such keys, which
# bounds what `join_split` broadcasts.
HOT_SHARE = 0.001


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster shares; a local one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back. Lost executors cost nothing of it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def row_key() -> Column:
    """A sortable key of a document: its id, nulls last, then a hash of its text."""
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash")
    )


def join_split(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of `rows` with `groups`, which has each key once and its number of rows in `count`.

    Keys with a share of HOT_SHARE or more are joined by broadcast: they are at most
    1 / HOT_SHARE rows, so their rows need not meet in one task. The others are joined by shuffle.
    """
    hot = groups.filter(F.col(count) >= F.lit(max(2.0, total * HOT_SHARE)))
    cold = groups.filter(F.col(count) < F.lit(max(2.0, total * HOT_SHARE)))
    return rows.join(F.broadcast(hot), keys).unionByName(
        rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    )
