"""Merkle manifest of a dataset, with a version of its tree for each changed leaf.

Every document is a leaf. The leaves of a source, in order of their ids, make a tree in which ARITY
successive nodes have one parent; the roots of the sources, in order of their names, make the last tree
in the same way. Digests are SHA-256 in lower-case hexadecimal, of the children's digests as text.

Trees are built in aligned blocks of ARITY ** LEVELS successive nodes: a block is one row, whatever the
source's size, and gives one node of the next pass, until each tree is one node. Then every
block is told the way from its root up: at each level the siblings on either side. A version is persistent: of the tree
with one changed leaf it copies only the ancestors of that leaf, inside its block first, then along the way up,
and shares all other nodes with the tree as it was. So a version is a path of new digests.

Places in a source are counted in two steps, inside ranges of (source, id) and over ranges, so a source
with a third of all rows is spread over as many tasks as its rows need. Rows that move hold digests, not texts.

Defined cases: a null field is hashed as `-`. The null source comes first. Null ids come last; rows
with equal ids are ordered by their leaf, and repeated rows are leaves of their own. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals.llm.common import store, table

ARITY, LEVELS = 16, 2
BLOCK = ARITY**LEVELS
# Leaves of one range, about, when places are counted.
RANGE_ROWS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

WAY = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def grow(leaves: list[str], nodes: int) -> list[list[str]]:
    """The levels of a block, from its leaves to its root, in a tree that has `nodes` nodes at the level of the leaves.

    A block of a tree with several blocks has LEVELS levels above its leaves, even with a single leaf.
    """
    levels = [leaves]
    for _ in range(LEVELS):
        if nodes == 1:
            break
        below = levels[-1]
        levels.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
        nodes = -(-nodes // ARITY)
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """The digests before and after leaf `at` and each of its ancestors but the root, in their runs."""
    out = []
    for level in levels[:-1]:
        first = at - at % ARITY
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + ARITY])))
        at //= ARITY
    return out


def copied(leaf: str, way: list[tuple[str, str]]) -> list[str]:
    """The nodes that a version with this leaf does not share: the leaf, and its ancestors up to the root."""
    out = [leaf]
    for before, after in way:
        out.append(digest(before + out[-1] + after))
    return out


def leaf_of(columns: dict[str, Column] | None = None) -> Column:
    """Digest of a row's fields: `-` for null, else the length in bytes, a colon, and the value."""
    parts = []
    for name in FIELDS:
        value = (columns or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def placed(rows: DataFrame, tree: str, order: list[Column], count: int) -> DataFrame:
    """Add `place` (from 0) and `nodes` (number of rows) of each row of a tree, given by the column `tree`.

    Rows are sorted by range over all trees; a tree's rows are counted in each range, and these counts summed.
    """
    ranged = rows.repartitionByRange(max(1, math.ceil(count / RANGE_ROWS)), F.col(tree), *order)
    ranged = store(ranged.sortWithinPartitions(F.col(tree), *order).withColumn("part", F.spark_partition_id()))
    of_tree = Window.partitionBy(tree)
    parts = (
        ranged.groupBy(tree, "part")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.col(tree).alias("of"),
            F.col("part").alias("in_part"),
            F.coalesce(F.sum("rows").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
            F.sum("rows").over(of_tree).alias("nodes"),
        )
    )
    inside = F.row_number().over(Window.partitionBy(tree, "part").orderBy(*order)) - 1
    return (
        ranged.withColumn("inside", inside)
        .join(parts, (F.col(tree) == F.col("of")) & (F.col("part") == F.col("in_part")))
        .withColumn("place", F.col("before") + F.col("inside"))
        .drop("of", "in_part", "part", "inside", "before")
    )


def _blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """One row for each block of (tree, place, nodes, digest): its nodes in order, and its root."""
    block = F.floor(F.col("place") / BLOCK).cast("bigint").alias("block")
    row = F.struct("place", "digest", *carried)
    grouped = nodes.groupBy("tree", block, "nodes").agg(F.array_sort(F.collect_list(row)).alias("rows"))

    @F.pandas_udf("string")
    def root(digests: pd.Series, nodes: pd.Series) -> pd.Series:
        return pd.Series([grow(list(d), n)[-1][0] for d, n in zip(digests, nodes, strict=True)], dtype=object)

    return store(grouped.withColumn("root", root(F.col("rows.digest"), F.col("nodes"))))


def _passes(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each pass over (tree, place, nodes, digest), and the roots of the trees: tree, root."""
    passes: list[DataFrame] = []
    while True:
        blocks = _blocks(nodes, *(c for c in nodes.columns if c not in ("tree", "place", "nodes", "digest")))
        passes.append(blocks)
        if (blocks.agg(F.max("nodes")).first()[0] or 0) <= BLOCK:
            return passes, blocks.select("tree", "root")
        above = F.ceil(F.col("nodes") / BLOCK).cast("bigint").alias("nodes")
        nodes = blocks.select("tree", F.col("block").alias("place"), above, F.col("root").alias("digest"))


def _down(blocks: DataFrame, ways: DataFrame) -> DataFrame:
    """The ways up of the nodes of `blocks`, from the ways of the blocks' roots: (tree, block, way, subroot, top)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.itertuples(index=False):
                levels, up = grow(list(block.digests), block.nodes), _way(block.way)
                yield pd.DataFrame(
                    {
                        "tree": [block.tree] * len(levels[0]),
                        "block": [block.block * BLOCK + i for i in range(len(levels[0]))],
                        "way": [_structs(siblings(levels, i) + up) for i in range(len(levels[0]))],
                        "subroot": block.subroot,
                        "top": block.top,
                    }
                )

    told = blocks.join(ways, ["tree", "block"]).select("tree", "block", "nodes", F.col("rows.digest").alias("digests"), "way", "subroot", "top")
    return told.mapInPandas(rows, f"tree struct<name:string>, block bigint, way {WAY}, subroot string, top string")


def _way(rows: object) -> list[tuple[str, str]]:
    return [(r["before"], r["after"]) for r in rows]


def _structs(way: list[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"before": b, "after": a} for b, a in way]


def manifest(docs: DataFrame, changed: DataFrame | Column | None = None) -> DataFrame:
    """The tree and the versions of `docs`, one row for each document.

    Returns doc_id, leaf, subroot (of its source), root (of all), siblings (before and after it at each
    level, upwards: the proof), and copied: the nodes of its own version, from the leaf to the root.
    `changed` is the text of a changed document as an expression, null where it is unchanged; its version
    then has the changed leaf, and every other document's the leaf as it is.
    """
    other = F.lit(None).cast("string") if changed is None else F.when(changed.isNotNull(), leaf_of({"text": changed}))
    leaves = store(
        docs.select(F.struct(F.col("source").alias("name")).alias("tree"), "doc_id", leaf_of().alias("digest"), other.alias("changed"))
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("digest"), F.col("changed")]
    passes, subroots = _passes(placed(leaves, "tree", order, leaves.count()))
    sources = subroots.select(F.struct(F.lit("").alias("name")).alias("tree"), F.col("tree.name").alias("name"), F.col("root").alias("digest"))
    above, roots = _passes(placed(sources, "tree", [F.col("name").asc_nulls_first()], sources.count()))
    nothing = F.array().cast(WAY)
    ways = roots.select("tree", F.lit(0).cast("bigint").alias("block"), nothing.alias("way"), F.lit("").alias("subroot"), F.col("root").alias("top"))
    for blocks in above[::-1]:
        ways = _down(blocks, ways)
    # From places in the last tree to the sources that stand there.
    ways = store(ways)
    names = above[0].select(F.explode("rows").alias("r")).select(F.col("r.place").alias("block"), F.col("r.name").alias("name"), F.col("r.digest").alias("of"))
    ways = ways.join(names, "block").select(
        F.struct("name").alias("tree"), F.lit(0).cast("bigint").alias("block"), "way", F.col("of").alias("subroot"), "top"
    )
    for blocks in passes[:0:-1]:
        ways = store(_down(blocks, ways))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.itertuples(index=False):
                leaves = list(block.digests)
                levels, up = grow(leaves, block.nodes), _way(block.way)
                whole = [siblings(levels, i) + up for i in range(len(leaves))]
                new = [c or d for c, d in zip(block.changed, leaves, strict=True)]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([None if pd.isna(i) else int(i) for i in block.doc_ids], "Int64"),
                        "leaf": leaves,
                        "subroot": block.subroot,
                        "root": block.top,
                        "siblings": [_structs(w) for w in whole],
                        "copied": [copied(leaf, w) for leaf, w in zip(new, whole, strict=True)],
                    }
                )

    told = passes[0].join(ways, ["tree", "block"]).select(
        "nodes",
        F.col("rows.digest").alias("digests"),
        F.transform("rows.doc_id", lambda i: i.cast("string")).alias("doc_ids"),
        F.col("rows.changed").alias("changed"),
        "way",
        "subroot",
        "top",
    )
    return told.mapInPandas(rows, f"doc_id bigint, leaf string, subroot string, root string, siblings {WAY}, copied array<string>")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    proof = F.array_join(F.transform("siblings", lambda s: F.concat(s["before"], s["after"])), "")
    folded = F.element_at("copied", -1)
    return manifest(docs, F.when(tampered, lower)).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


def _sql(depth: int = 6, top_depth: int = 4) -> str:
    """The same for sources of at most ARITY ** depth documents, and ARITY ** top_depth sources."""
    field = "coalesce(strlen(({0})::VARCHAR) || ':' || ({0})::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field.format(c if c != "text" else text) for c in FIELDS) + ")"
    steps = [
        f"""crc_table AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
            FROM range(256) r(i)
        )""",
        f"""docs AS (
            SELECT *, doc_id IS NOT NULL AND xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                                      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 5 = 0 AS tampered
            FROM documents, crc_table
        )""",
        f"""leaves AS (
            SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {leaf('text')} AS d,
                   CASE WHEN tampered THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {leaf('text')} END AS v
            FROM docs
        )""",
        """s0 AS (
            SELECT doc_id, tree, d, v, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, d) - 1 AS p, count(*) OVER (PARTITION BY tree) AS n
            FROM leaves
        )""",
    ]

    def grown(name: str, levels: int) -> None:
        run = f"OVER (PARTITION BY tree, p // {ARITY} ORDER BY p ROWS BETWEEN"
        for k in range(levels):
            steps.append(
                f"""{name}w{k} AS (
                    SELECT tree, p, n, coalesce(string_agg(d, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
                           coalesce(string_agg(d, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
                    FROM {name}{k}
                )"""
            )
            steps.append(
                f"""{name}{k + 1} AS (
                    SELECT tree, p // {ARITY} AS p, CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY p)) END AS d, (n + {ARITY - 1}) // {ARITY} AS n
                    FROM {name}{k} GROUP BY tree, p // {ARITY}, n
                )"""
            )

    grown("s", depth)
    steps.append(f"t0 AS (SELECT 0 AS tree, tree AS p, d, count(*) OVER () AS n FROM s{depth})")
    grown("t", top_depth)
    # Up from each document, level by level: its siblings so far, and its version's node.
    steps.append("u0 AS (SELECT doc_id, tree, p, d, v, '' AS proof FROM s0)")
    last = 0
    for k in range(depth + top_depth):
        own, level = ("s", k) if k < depth else ("t", k - depth)
        at = f"u.p // {ARITY**level}" if own == "s" else f"u.tree // {ARITY**level}"
        tree = "w.tree = u.tree AND " if own == "s" else ""
        steps.append(
            f"""u{k + 1} AS (
                SELECT doc_id, u.tree, u.p, d, CASE WHEN n = 1 THEN v ELSE sha256(b || v || a) END AS v, proof || b || a AS proof
                FROM u{k} u JOIN {own}w{level} w ON {tree}w.p = {at}
            )"""
        )
        last = k + 1
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
        SELECT doc_id, u.d AS leaf, s.d AS subroot, r.d AS root, sha256(proof) AS proof_sha256, v AS folded_root, v = r.d AS verified
        FROM u{last} u JOIN s{depth} s ON s.tree = u.tree, t{top_depth} r"""
    )


QUERIES = {"op12_merkle": op12_merkle}
SQL = {"op12_merkle": _sql()}
