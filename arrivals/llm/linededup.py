"""Line dedup by overlapping windows of three lines.

Every three consecutive lines are hashed. A window that occurs more than once in the corpus keeps
its first occurrence, by document and position; every later one covers its lines, overlapping
covers are merged, and the covered lines are removed.

Only DataFrame functions are used. Windows are hashed within their row, so no line moves but as a
16-byte hash; first occurrences are minima, aggregated before the shuffle; windows with a large
share of all rows are joined by broadcast (`join_split`).

Defined cases: lines are compared without spaces at either end; blank lines belong to no window and
go only with covered lines around them. Texts of fewer than three lines are untouched; null text
stays null. Repeats of one document (same id, same text) have the same occurrences, and so
the same lines stay in all of them. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm.common import join_split, row_key, store, table

LINES = 3


def windows(docs: DataFrame) -> DataFrame:
    """Each window: key of its document, positions of its first and last line, and two hashes."""
    lines = docs.select(row_key().alias("key"), F.split("text", "\n").alias("lines")).select(
        "key",
        F.filter(
            F.transform("lines", lambda line, i: F.struct(i.alias("at"), F.trim(line).alias("line"))),
            lambda x: x["line"] != "",
        ).alias("solid"),
    )

    def window(i):
        within = [F.get("solid", i + k) for k in range(LINES)]
        return F.struct(
            within[0]["at"].alias("first"),
            within[-1]["at"].alias("last"),
            F.xxhash64(*[w["line"] for w in within]).alias("a"),
            F.xxhash64(F.lit(LINES), *[w["line"] for w in reversed(within)]).alias("b"),
        )

    starts = F.sequence(F.lit(0), F.size("solid") - LINES)
    return (
        lines.filter(F.size("solid") >= LINES)
        .select("key", F.explode(F.transform(starts, window)).alias("w"))
        .select("key", "w.first", "w.last", "w.a", "w.b")
    )


def covered(docs: DataFrame) -> DataFrame:
    """For each document with later occurrences: its key and the merged ranges of covered lines."""
    occurrences = store(windows(docs))
    repeats = store(
        occurrences.groupBy("a", "b")
        .agg(F.min(F.struct("key", "first")).alias("origin"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
    )
    later = join_split(occurrences, repeats, ["a", "b"], "times", occurrences.count()).filter(
        F.struct("key", "first") > F.col("origin")
    )
    # A range begins with a window that starts after the end of the one before, and ends likewise.
    begins = F.expr(
        """transform(filter(transform(found, (w, i) -> named_struct('at', w.first, 'before', get(found, i - 1).last)),
                            r -> r.before IS NULL OR r.at > r.before), r -> r.at)"""
    )
    ends = F.expr(
        """transform(filter(transform(found, (w, i) -> named_struct('at', w.last, 'after', get(found, i + 1).first)),
                            r -> r.after IS NULL OR r.after > r.at), r -> r.at)"""
    )
    return (
        later.groupBy("key")
        .agg(F.collect_set(F.struct("first", "last")).alias("found"))
        .withColumn("found", F.sort_array("found"))
        .select("key", begins.alias("begins"), ends.alias("ends"))
        .select("key", F.expr("transform(begins, (b, i) -> named_struct('first', b, 'last', ends[i]))").alias("ranges"))
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, and text without the later occurrences of repeated windows."""
    ids = docs.select("doc_id", "text", row_key().alias("key"))
    joined = ids.join(covered(docs), "key", "left").withColumn("lines", F.split("text", "\n"))
    # What stays lies before the first range, between two, and after the last one.
    kept = F.expr(
        """CASE WHEN ranges IS NULL THEN lines ELSE flatten(transform(sequence(0, size(ranges)), i ->
            slice(lines, coalesce(get(ranges, i - 1).last + 2, 1),
                  coalesce(get(ranges, i).first, size(lines)) - coalesce(get(ranges, i - 1).last + 1, 0)))) END"""
    )
    return joined.withColumn("kept", kept).select(
        "doc_id",
        F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.array_join("kept", "\n").alias("text"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


QUERIES = {"op6_line_dedup": op6_line_dedup}
SQL = {
    "op6_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS pos
            FROM documents
        ), w AS (
            SELECT doc_id, pos AS head, lead(pos, 2) OVER d AS tail,
                   [trim(line), lead(trim(line)) OVER d, lead(trim(line), 2) OVER d] AS three
            FROM lines WHERE trim(line) <> ''
            WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
        ), later AS (
            SELECT doc_id, head, tail
            FROM (SELECT *, row_number() OVER (PARTITION BY three ORDER BY doc_id, head) AS nth FROM w WHERE tail IS NOT NULL)
            WHERE nth > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(head, tail + 1)) AS pos FROM later
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS text
            FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT doc_id, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines,
               coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(kept.n, 0) AS n_removed,
               CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
        FROM documents d LEFT JOIN kept USING (doc_id)"""
}
