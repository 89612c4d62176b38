"""MinHash near-dedup with circulant signatures.

A document is the set of its word shingles. Two permutations of the 32-bit numbers make a whole
signature: the first scatters the shingles, the second is shifted round by one place for each further
coordinate, whose value is the least number of the set under it. Bands of coordinates are buckets;
documents that meet in a bucket are candidates, and a link needs the exact Jaccard similarity of the
full sets.

Groups of copies of any size stay linear: texts with equal sets are one class from the start. In a
small bucket all classes are compared. In large ones the shingles are counted: classes that share a rare
one are compared, and of others it is known that they share no more than their frequent ones. Each is
compared with the most central class of its bucket, the one with the least share of rare shingles; then
those that this leaves in different components are compared if they meet in a shingle of their prefixes: in the
order of frequency, the first n - ceil(0.8 n) + 1 of n shingles, one of which two linked sets always share.
Only frequent shingles of a prefix count, since rare ones have been compared; the places of the shared
shingle bound what is left to share. No link between components is missed. All of it is keyed by hashes,
hot buckets and classes are joined by broadcast (`join_split`), hot shingles are dealt over tasks, and texts move
only for classes that share a bucket with another.

A pair at the threshold misses all BANDS bands with probability (1 - 0.8**ROWS)**BANDS, about 5e-8.

Defined cases: null texts and texts without words have no shingles, no links, and are kept. Texts of
fewer words than a shingle are one shingle. Repeats of one doc_id are one document with
several texts: they are in one component, kept or dropped together. A document without an id links
nothing: it is a component of its own with a null component_id, and is kept. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals.llm.common import join_split, row_key, store, table
from arrivals.llm.components import components
from arrivals.llm.hashing import mix, sequences, words_hashed

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 32, 4
# Classes that meet in a bucket, or in a shingle, are all compared up to this number.
SMALL = 16
# Classes that meet in a shingle of their prefixes are dealt into parts of about this number.
PART = 1_000
BATCH = 512
_M1, _M2 = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)


def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    return [np.unique(sequences(words, k)) for words in words_hashed(texts)]


def _scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation."""
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
    return x ^ (x >> np.uint32(15))


def signature(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k: the least value of the second permutation, shifted by k, over the scattered shingles."""
    scattered = _scatter((shingles >> np.uint64(32)).astype(np.uint32))
    shifts = np.arange(size, dtype=np.uint32)
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), BATCH):
        x = scattered[at : at + BATCH, None] + shifts
        x ^= x >> np.uint32(16)
        x *= _M1
        x ^= x >> np.uint32(13)
        x *= _M2
        np.minimum(out, x.min(axis=0), out=out)
    return out


def bands(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band."""
    of = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), of.shape[:2])
    for i in range(ROWS):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + of[:, :, i])
    return total.view(np.int64)


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    """key, set (16-byte digest of the shingles; null if there are none), n_shingles, and buckets."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                some = batch.iloc[at : at + BATCH]
                sets = shingle_sets(list(some["text"]), k)
                digests = [
                    np.array([mix(s).sum(), mix(s ^ np.uint64(0x5555555555555555)).sum()], np.uint64).tobytes() if len(s) else None
                    for s in sets
                ]
                found = bands(np.stack([signature(s) for s in sets]))
                yield pd.DataFrame(
                    {
                        "no_id": some["no_id"], "doc_id": some["doc_id"], "text_hash": some["text_hash"],
                        "set": digests, "n_shingles": [len(s) for s in sets], "buckets": list(found),
                    }
                )

    rows = docs.select(row_key().alias("key"), F.col("text").cast("binary").alias("text")).select("key.*", "text")
    schema = "no_id boolean, doc_id bigint, text_hash bigint, set binary, n_shingles bigint, buckets array<bigint>"
    return rows.mapInPandas(sketch, schema).select(
        F.struct("no_id", "doc_id", "text_hash").alias("key"), "set", "n_shingles", "buckets"
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union, stored."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                some = batch.iloc[at : at + BATCH]
                of = {t: i for i, t in enumerate(dict.fromkeys([*some["text_a"], *some["text_b"]]))}
                sets = shingle_sets(list(of), k)
                linked = []
                for x, y in zip(some["text_a"], some["text_b"], strict=True):
                    a, b = sets[of[x]], sets[of[y]]
                    both = np.sort(np.concatenate([a, b]))
                    common = int((both[1:] == both[:-1]).sum())
                    linked.append(100 * common >= percent * (len(both) - common))
                yield some.loc[linked, ["a", "b"]]

    left = texts.select(F.col("set").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("set").alias("b"), F.col("text").alias("text_b"))
    return store(pairs.join(left, "a").join(right, "b").mapInPandas(check, "a binary, b binary"))


def _rare_shingles(texts: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of shingles that at most SMALL sets of `texts` have: how many a set has (set, own), and pairs (a, b) that share one.

    Shingles with the same sets count once for the pairs. The third is the other shingles: (set, shingle, times).
    """

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                some = batch.iloc[at : at + BATCH]
                found = shingle_sets(list(some["text"]), k)
                yield pd.DataFrame(
                    {"set": some["set"].repeat([len(s) for s in found]), "shingle": np.concatenate(found).view(np.int64)}
                )

    having = store(texts.select("set", "text").mapInPandas(shingles, "set binary, shingle bigint"))
    times = having.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    rare = store(having.join(times.filter(F.col("times") <= SMALL), "shingle"))
    own = rare.groupBy("set").agg(F.count(F.lit(1)).alias("own"))
    together = rare.filter("times > 1").groupBy("shingle").agg(F.sort_array(F.collect_set("set")).alias("sets")).select("sets").distinct()
    pairs = together.select(F.posexplode("sets").alias("i", "a"), "sets").select("a", F.explode(F.expr("slice(sets, i + 2, size(sets))")).alias("b"))
    return own, pairs.distinct(), having.join(times.filter(F.col("times") > SMALL), "shingle")


def _may_link(n: Column, own: Column, other_n: Column, other_own: Column, percent: int) -> Column:
    """Whether two sets that share none of their `own` shingles could be linked: what they share is at most the rest of either."""
    most = F.least(n - own, other_n - other_own)
    return 100 * most >= percent * (n + other_n - most)


def _pairs(classes: DataFrame, key: str, percent: int) -> DataFrame:
    """Pairs of classes of (key, set, n, own) that meet under a key and could be linked."""
    x, y = classes.alias("x"), classes.alias("y")
    on = (F.col(f"x.{key}") == F.col(f"y.{key}")) & (F.col("x.set") < F.col("y.set"))
    on = on & _may_link(F.col("x.n"), F.col("x.own"), F.col("y.n"), F.col("y.own"), percent)
    return x.join(y, on).select(F.col("x.set").alias("a"), F.col("y.set").alias("b"))


def _pairs_apart(apart: DataFrame, frequent: DataFrame, percent: int, total: int) -> DataFrame:
    """Pairs of classes of (set, n, own, comp, all) in different components that could be linked through a frequent shingle.

    They meet in one of `all`, their buckets, and in a shingle of both prefixes.
    """
    n, own, order = F.col("n"), F.col("own"), Window.partitionBy("set").orderBy("times", "shingle")
    unsure = apart.withColumn("prefix", n - F.floor((percent * n + 99) / 100) + 1).filter("own < prefix")
    # Rare shingles come first, so a frequent one has them all before it.
    placed = frequent.join(unsure, "set").withColumn("place", own + F.row_number().over(order)).filter("place <= prefix")
    placed = store(placed.drop("times", "prefix"))
    met = placed.groupBy("shingle").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    placed = join_split(placed, met, ["shingle"], "met", total).withColumn("parts", F.ceil(F.col("met") / PART))
    x = placed.withColumn("part", F.pmod(F.xxhash64("set"), "parts")).alias("x")
    y = placed.withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))).alias("y")
    most = 1 + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    on = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.set") < F.col("y.set"))
    on = on & (F.col("x.comp") != F.col("y.comp")) & (100 * most >= percent * (F.col("x.n") + F.col("y.n") - most))
    on = on & _may_link(F.col("x.n"), F.col("x.own"), F.col("y.n"), F.col("y.own"), percent) & F.arrays_overlap("x.all", "y.all")
    return x.join(y, on).select(F.col("x.set").alias("a"), F.col("y.set").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row."""
    rows = store(_sketches(docs, k))
    total = rows.count()
    classes = store(
        rows.filter("set IS NOT NULL")
        .groupBy("set")
        .agg(
            F.min("key").alias("key"),
            F.min(F.when(~F.col("key.no_id"), F.col("key.doc_id"))).alias("doc_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n"),
            F.first("buckets").alias("buckets"),
        )
    )
    in_bucket = classes.select("set", "n", F.explode("buckets").alias("bucket"))
    shared = store(in_bucket.groupBy("bucket").agg(F.min("set").alias("least"), F.count(F.lit(1)).alias("met")).filter("met > 1"))
    members = store(join_split(in_bucket, shared, ["bucket"], "met", total))
    met = members.select("set").distinct().join(classes.select("set", "key"), "set")
    texts = docs.select(row_key().alias("key"), F.col("text").cast("binary").alias("text")).join(met, "key")
    # Repeated rows have one key; one of their texts is enough, and they are the same.
    texts = store(texts.groupBy("set").agg(F.first("text").alias("text")))

    # Small buckets: every pair. Large ones: each class with the most central one of its bucket.
    small = members.filter(F.col("met") <= SMALL).select("bucket", "set", "n", F.lit(0).cast("bigint").alias("own"))
    large = members.filter(F.col("met") > SMALL).select("bucket", "set", "n")
    own, sharing, frequent = _rare_shingles(texts.join(large.select("set").distinct(), "set", "left_semi"), k)
    large = store(large.join(own, "set", "left").select("bucket", "set", "n", F.coalesce("own", F.lit(0)).alias("own")))
    centres = large.groupBy("bucket").agg(F.min(F.struct(F.col("own") / F.col("n"), "set", "n", "own")).alias("c"))
    to_centre = join_split(large, centres.join(shared, "bucket"), ["bucket"], "met", total).filter("set <> c.set")
    possible = _may_link(F.col("n"), F.col("own"), F.col("c.n"), F.col("c.own"), percent)
    first = store(
        to_centre.filter(possible)
        .select(F.least("set", "c.set").alias("a"), F.greatest("set", "c.set").alias("b"))
        .unionByName(sharing)
        .unionByName(_pairs(small, "bucket", percent))
        .distinct()
    )
    links = _confirmed(first, texts, k, percent)
    labels = components(links)
    labelled = large.join(labels.withColumnRenamed("node", "set"), "set", "left").select(
        "bucket", "set", "n", "own", F.coalesce("comp", "set").alias("comp")
    )
    mixed = labelled.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("bucket")
    apart = store(
        labelled.join(mixed, "bucket", "left_semi")
        .groupBy("set")
        .agg(*[F.first(c).alias(c) for c in ("n", "own", "comp")], F.collect_set("bucket").alias("all"))
    )
    if apart.limit(1).count():
        second = _pairs_apart(apart, frequent, percent, total).join(first, ["a", "b"], "left_anti")
        links = links.unionByName(_confirmed(second, texts, k, percent))
    # Rows with one id are one document: the classes of its texts are linked through it.
    several = rows.filter("set IS NOT NULL AND NOT key.no_id").groupBy("key.doc_id").agg(F.min("set").alias("a"), F.max("set").alias("z")).filter("a <> z")
    same = rows.join(several, F.col("key.doc_id") == F.col("doc_id")).filter("set <> a").select("a", F.col("set").alias("b"))
    labels = components(links.unionByName(same))

    of = classes.join(labels.withColumnRenamed("node", "set"), "set", "left").select(
        "set", "doc_id", "copies", F.coalesce("comp", "set").alias("comp")
    )
    of = store(of)
    least = store(of.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("sets")))
    of = store(join_split(of.drop("doc_id"), least, ["comp"], "sets", total).select("set", "copies", "component_id"))
    own = F.col("key.doc_id")
    linked = join_split(rows.filter("set IS NOT NULL"), of, ["set"], "copies", total).select(
        own.alias("doc_id"), "n_shingles", F.when(own.isNotNull(), F.col("component_id")).alias("component_id")
    )
    alone = rows.filter("set IS NULL").select(own.alias("doc_id"), "n_shingles", own.alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near duplicates, with the columns of `docs`: that of the least id, a null one last.

    Every row is a document of its own here, repeated rows and those with null or equal ids too; of equal
    ones any one stays. The rows are stored with a number, which names them.
    """
    numbered = store(docs.select(F.struct(*docs.columns).alias("whole"), F.monotonically_increasing_id().alias("row")))
    found = near_duplicates(numbered.select(F.col("row").alias("doc_id"), F.col("whole.text").alias("text")), k, percent)
    ids = numbered.select("row", F.col("whole.doc_id").alias("own"))
    least = F.min(F.struct(F.col("own").isNull().alias("no_id"), "own", "row")).alias("least")
    best = found.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row").groupBy("component_id").agg(least)
    return numbered.join(best.select("least.row"), "row", "left_semi").select("whole.*")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)


QUERIES = {"op3_minhash": op3_minhash}
SQL = {
    "op3_minhash": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS words FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(words[p : p + least(4, len(words)) - 1], ' ') AS shingle
            FROM (SELECT *, unnest(range(1, len(words) - least(4, len(words)) + 2)) AS p FROM d WHERE len(words) > 0)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), c AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY ALL
        ), l AS (
            SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
        ), e AS (
            SELECT a, b FROM l UNION ALL SELECT b, a FROM l
        ), r AS (
            SELECT doc_id, doc_id AS reached FROM documents
            UNION
            SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, min(reached) AS component_id, doc_id = min(reached) AS kept
        FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id, n"""
}
