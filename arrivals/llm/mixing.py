"""Mixing sources to target weights by weighted fair queueing.

Each source has a target: its share, by weight, of a token budget. Sources send their documents in a
shuffled order (by digest), a second round after the first. A document's virtual finish time
is the number of tokens its source has sent by its end, divided by the source's target; all documents
are put in the order of that time and the mix is cut off at the budget.

Running sums are taken in two steps, over buckets and within a bucket, first of each source's order,
then of the global one: a source with a third of all rows is dealt over as many tasks as there are
buckets. The global order is so range-partitioned by time. Texts do not move: the outcome is, for
each source, the last document it may send, and every row is compared with that.

Defined cases: null text has size 0 and is never taken; a null source is a source of its own, the last
one. Wholly repeated rows are one unit, taken or left together. No budget, or a table without
words, takes nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals.llm.common import WORD, fresh, store, table, text_or_empty

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
ROUNDS = 2
# Rows in a bucket of a source's order, about; buckets of the global order hold a few times as many.
BUCKET_ROWS = 2_000
SEED = "mix"


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


def _order() -> Column:
    """Place of a document in its source's shuffled order: 32 hexadecimal digits."""
    parts = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_or_empty().cast("binary"))
    return F.md5(F.concat_ws(":", F.lit(SEED), *parts).cast("binary"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, rounds: int = ROUNDS) -> DataFrame:
    """source, source_size, target from rows of (source, size); one row for each source.

    Weights go round the sources in code point order. No target exceeds `rounds` times its source;
    the excess goes to the others by weight. With sources in the order of cap over weight, the capped
    ones come first: the level, words for each unit of weight, is the one of the first source
    that it does not fill.
    """
    every, named = Window.partitionBy(), Window.orderBy(F.col("source").isNull(), "source")
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    upto, onward = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    weight = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(named) - 1) % len(weights))
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumns({"weight": weight, "cap": rounds * F.col("source_size")})
        .withColumn("left", F.lit(budget) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(upto), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onward))
        .withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(every))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
        .select("source", "source_size", F.coalesce("target", F.col("cap").cast("double")).alias("target"))
    )


def _running(rows: DataFrame, group: list[str], bucket: str, order: list[str | Column], out: str) -> DataFrame:
    """Add `out`: the sum of `size` over a group, in its order, up to and with the row. Buckets follow the order."""
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*group, bucket)
        .agg(F.sum("size").alias("of_bucket"))
        .select(*group, bucket, F.coalesce(F.sum("of_bucket").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn(out, F.sum("size").over(inside))
        .join(offsets, [*group, bucket])
        .withColumn(out, F.col(out) + F.col("offset"))
        .drop("offset")
    )


def plan(sized: DataFrame, rows: int, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, rounds: int = ROUNDS) -> DataFrame:
    """For each source of the stored (source, place, size): its target and the last unit it sends.

    A unit is (round, place); `last_round` and `last_place` are null if the source sends none.
    """
    goals = store(targets(sized, weights, budget, rounds).withColumn("source", F.struct("source")))
    buckets = max(16, math.ceil(rows / BUCKET_ROWS))
    # A null source joins like any other as a struct that holds it.
    first_digits = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint")
    units = (
        sized.filter("size > 0")
        .groupBy(F.struct("source").alias("source"), "place")
        .agg(F.sum("size").alias("size"))
        .withColumn("bucket", (first_digits * buckets / 2**32).cast("bigint"))
    )
    sent = _running(units, ["source"], "bucket", ["place"], "sent").join(goals, "source")
    finish = (F.col("round") * F.col("source_size") + F.col("sent")) / F.col("target")
    queued = (
        sent.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
        .withColumn("finish", finish)
        # From 0 to 1 evenly, beyond that ever more coarsely; the cut lies near 1.
        .withColumn("slot", (F.col("finish") / (1 + F.col("finish")) * 2 * buckets).cast("bigint"))
        .select("source", "round", "place", "size", "finish", "slot")
    )
    queued = _running(queued, [], "slot", ["finish", F.col("source.source").asc_nulls_last(), "round", "place"], "total")
    words = goals.agg(F.sum("source_size")).first()[0] or 0
    last = (
        queued.filter(F.col("total") <= budget * words)
        .groupBy("source")
        .agg(F.max(F.struct("round", "place")).alias("last"))
    )
    return (
        goals.join(last, "source", "left")
        .select(F.col("source.source").alias("source"), "source_size", "target", F.col("last.round").alias("last_round"), F.col("last.place").alias("last_place"))
    )


def _copies(rounds: int) -> Column:
    """How often a row is sent: the whole rounds before the last, and the last up to the cut."""
    reached = F.when(F.col("place") <= F.col("last_place"), 1).otherwise(0)
    return F.coalesce(F.when(F.col("size") > 0, F.col("last_round") + reached), F.lit(0))


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, source_size, target of its source, and taken: size times the rounds it is sent in."""
    sized = store(docs.select("doc_id", "source", _size().alias("size"), _order().alias("place")))
    ends = store(plan(sized.select("source", "place", "size"), sized.count(), weights, budget, rounds))
    ends = ends.withColumnRenamed("source", "of")
    return sized.join(ends, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies(rounds)).alias("taken")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, rounds: int = ROUNDS) -> DataFrame:
    """The documents of the mix, with the columns of `docs`; one that is sent twice is there twice."""
    sized = store(docs.select("source", _size().alias("size"), _order().alias("place")))
    ends = store(plan(sized, sized.count(), weights, budget, rounds))
    whole, sent = fresh(docs, "whole"), fresh(docs, "sent")
    rows = docs.select(F.struct(*docs.columns).alias(whole), "source", _size().alias("size"), _order().alias("place"))
    times = F.explode(F.array_repeat(F.lit(0), _copies(rounds).cast("int"))).alias(sent)
    ends = ends.withColumnRenamed("source", "of")
    return (
        rows.join(ends, F.col("source").eqNullSafe(F.col("of"))).select(whole, times).select(f"{whole}.*")
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents"))


QUERIES = {"op2_mixing": op2_mixing}
SQL = {
    "op2_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS place
            FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
                   [3, 1, 2][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)] AS weight
            FROM d GROUP BY source
        ), l AS (
            SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                       - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM s WINDOW f AS (ORDER BY cap / weight, source NULLS LAST)
        ), t AS (
            SELECT source, source_size,
                   least(cap::DOUBLE, max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight) AS target
            FROM l
        ), q AS (
            SELECT t.source, round, place, size,
                   (round * source_size + sum(size) OVER (PARTITION BY t.source, round ORDER BY place)) / target AS finish
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) r(round) WHERE size > 0
        ), m AS (
            SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, round, place ROWS UNBOUNDED PRECEDING) AS total FROM q
        ), c AS (
            SELECT source, place, count(*) AS copies FROM m
            WHERE total <= 1.5::DOUBLE * (SELECT sum(source_size) FROM t) GROUP BY source, place
        )
        SELECT doc_id, size, source_size, target, (size * coalesce(copies, 0))::BIGINT AS taken
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.place = c.place"""
}
