"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

A text is reduced to the SHA-256 of its characters other than blanks. The index holds one row for
each digest ever seen. A batch is first reduced to one row for each digest (aggregated before the
shuffle), then deduplicated by a sort-merge anti-join with the index, whose side is neither
shuffled nor sorted, and what is new is appended. Adding a batch again changes nothing, so a
failed load can simply be repeated.

Defined cases: null text counts as empty; empty texts equal one another and texts of blanks only. Of
equal texts in a batch the longest original stays, then the smallest `doc_id`, a null one last.
What the index already holds stays over anything in a batch. Rows repeated under the surviving id
are all marked as kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm.common import BLANKS, join_split, shared_folder, store, table, text_or_empty

ROWS_PER_BUCKET = 2_000_000
COLUMNS, ABOUT = "digest BINARY, keep_id BIGINT, chars INT", "buckets INT"


class BadIndex(ValueError):
    """There are digests at a path, but nothing says how they are stored."""


@dataclass(frozen=True)
class DigestIndex:
    """A table of (digest, keep_id, chars), bucketed and sorted by digest, at a path that outlives the session.

    How many buckets it has is decided once, when it is made, and stored beside it, at `path`_about. It is
    entered in the session's catalogue, which bucketed tables need, while it is open.
    """

    spark: SparkSession
    path: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int) -> DigestIndex:
        """The index at `path`, made with so many buckets if there is none; one that is there keeps its own."""
        about = f"{path}_about"
        if _stored(spark, about, ABOUT):
            buckets = spark.read.schema(ABOUT).parquet(about).first()["buckets"]
        elif _stored(spark, path, COLUMNS):
            raise BadIndex(f"{path} holds digests, but {about} does not say in how many buckets")
        else:
            spark.createDataFrame([(buckets,)], ABOUT).coalesce(1).write.mode("overwrite").parquet(about)
        index = cls(spark, path, buckets)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {index.name} ({COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return index

    def close(self) -> None:
        """Take the table out of the catalogue; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    @property
    def name(self) -> str:
        return "digests_" + hashlib.sha256(self.path.encode()).hexdigest()[:32]

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def missing(self, batch: DataFrame) -> DataFrame:
        """The rows of `batch` whose digest the index does not hold."""
        return batch.join(self.rows().hint("merge"), "digest", "left_anti")

    def append(self, batch: DataFrame) -> None:
        new = self.missing(batch).select("digest", "keep_id", "chars")
        new.repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def _stored(spark: SparkSession, path: str, schema: str) -> bool:
    try:
        return not spark.read.schema(schema).parquet(path).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def digests(docs: DataFrame) -> DataFrame:
    """Id, digest and length of each text."""
    bare = F.translate(text_or_empty(), BLANKS, "")
    return docs.select("doc_id", F.unhex(F.sha2(bare, 256)).alias("digest"), F.length(text_or_empty()).alias("chars"))


def dedup(docs: DataFrame, index_path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Add `docs` to the index and tell for each row which document stays for it.

    Returns doc_id, keep_id, group_size (rows of this batch with that digest), kept, text_sha256.
    `index_path` may hold an index of earlier batches, which keeps its number of buckets; without
    one, a new index is made in the shared folder, with `buckets` or as many as this batch needs.
    """
    spark = docs.sparkSession
    rows = store(digests(docs))
    total = rows.count()
    path = index_path or f"{shared_folder(spark)}/index"
    index = DigestIndex.open(spark, path, buckets or max(16, math.ceil(total / ROWS_PER_BUCKET)))
    best = F.min(F.struct((-F.col("chars")).alias("longest"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = store(
        rows.groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.longest")).alias("chars"), "group_size")
    )
    try:
        index.append(groups)
        stay = store(groups.select("digest", "group_size").join(index.rows().select("digest", "keep_id").hint("merge"), "digest"))
    finally:
        index.close()
    return join_split(rows, stay, ["digest"], "group_size", total).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op7_exact_dedup": op7_exact_dedup}
SQL = {
    "op7_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), g AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""
}
