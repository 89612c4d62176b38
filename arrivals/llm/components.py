"""Connected components by repeated contraction, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """node and comp, the least node of its component, for all nodes of `links` (columns a, b; no nulls).

    In each round every node takes the least of itself and its neighbours, and links are renamed
    after that; a star is done after one round, a chain after about the logarithm of its length.
    Rounds are stored, so neither lineage nor a lost executor makes them start again.
    """
    links = store(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while links.limit(1).count():
        ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(
            ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to"))
        )
        if labels is None:
            labels = least.select("node", F.col("to").alias("comp"))
        else:
            moved = least.select(F.col("node").alias("comp"), "to")
            labels = store(labels.join(moved, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))
        to_a = least.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        to_b = least.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        links = store(
            links.join(to_a, "a").join(to_b, "b").filter("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct()
        )
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return labels
