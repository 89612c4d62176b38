"""Substring dedup: fuzzy passages that repeat across documents, by collinear chaining.

Seeds are hashes of SEED successive words, of which winnowing keeps the least in every SPAN successive
ones: any SEED + SPAN - 1 words that two documents share hold a common seed. Of the documents that hold a seed the
first, by id, is matched with all others, at all their places, so a passage that thousands of documents share
costs one match for each seed and place, not one for each pair. What is then neither a copy nor the origin
of one is matched with the last document that holds the seed: an early document that has only a
piece of a passage does not hide it. What is still neither is matched with every other document that has two of its
seeds, NEAR to FAR words apart, however many there are: pieces in the first and the last document hide nothing either.
Such documents meet without the places of their seeds; these follow only where two matches lie at most REACH words apart in the
origin, since no chain begins elsewhere. Nor do they meet by a seed that stands twice in both, as in loops of a word, or where no chain is long
enough. The meetings still grow with the square of a seed's holders; of their passages those that others imply are dropped (`_linked`).

The matches of two documents are chained: in both they must go forward, each adds its words, and
gaps cost GAP a word. A Fenwick tree over positions in the origin document holds the best chain that
ends below each, so a document's matches are chained in n log n steps. Chains of enough words are aligned with
the words: gaps between matches by edit distance, ends as far as words agree. The longest stretch that is
long and alike enough is a passage of the document, a copy of one in its origin; so is each further
one before and behind it. A chain may thus hold several.

Hot seeds are joined by broadcast of their holders, hot documents by salting (`_with_words`); a group holds the
matches of one document with one other. Words move, as hashes, only for documents with a chain, and of these only the
stretch of a chain goes to Python.

What is not found: copies with less than two common seeds WORDS // 2 words apart (README has the share of near copies
found, by likeness); of those of which both the first and the last holder of the seeds have pieces only, the ones whose
common seeds are not NEAR words apart; ends of a passage more than MARGIN words beyond its last common seed. In gaps of more than LONG_GAP words only
words at equal distance from the gap's start count as agreeing.

Defined cases: null and short texts have no seeds. Repeats within one document are not reported. Rows with equal
ids are documents of their own, ordered by a hash of the text; wholly repeated rows are one. A null id
comes first. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals.llm.common import HOT_SHARE, store, table
from arrivals.llm.hashing import mix, sequences, words_hashed

SEED, SPAN = 4, 10
# A passage: least words, least share of words that agree, price of a word in a gap.
WORDS, ALIKE, GAP = 50, 0.8, 0.25
# Words around a chain that its ends may grow by; words of a gap that are aligned one by one; words
# in which an end may find no agreement before it stops growing.
MARGIN, LONG_GAP, DROP = 64, 200, 6
# Bytes of the texts whose seeds are found at once, besides the last one of them.
BATCH_BYTES = 1 << 20
# Bits of the sieve for each key that is sought, and the most of them in all (a row has SIEVE_ROW).
SIEVE_BITS, SIEVE_ROW, SIEVE_ROWS = 16, 1 << 15, 1 << 12
# Turns in which the texts of documents with a chain are sought.
TURNS = 2
# Words between two seeds by which what is left meets all other documents. Any passage has a stretch of less than
# 2 * WORDS that is alike enough; in WORDS equal ones, seeds begin within SPAN - 1 words of either end.
NEAR, FAR = WORDS - SEED - 2 * (SPAN - 1), 2 * WORDS - SEED
# Words between two matches in the origin beyond which no chain begins with them, by the rules of `chain`.
REACH = max(y for x in range(1, 100) for y in range(1, 100) if GAP * (x + y) / 2 < min(SEED, (1 + GAP) * min(SEED, x, y)))


def seeds(words: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the winnowed seeds of a text, each once, and for each its positions."""
    if len(words) < SEED:
        return [], words[:0]
    found = sequences(words, SEED)
    if len(found) <= SPAN:
        at = np.array([int(np.argmin(found))])
    else:
        at = np.unique(np.argmin(np.lib.stride_tricks.sliding_window_view(found, SPAN), axis=1) + np.arange(len(found) - SPAN + 1))
    order = np.argsort(found[at], kind="stable")
    hashes, first = np.unique(found[at][order], return_index=True)
    return np.split(at[order], first[1:]), hashes


class Fenwick:
    """Greatest value, and whose it is, over the places up to a given one."""

    def __init__(self, size: int):
        self.value, self.owner = [float("-inf")] * (size + 1), [-1] * (size + 1)

    def put(self, place: int, value: float, owner: int) -> None:
        place += 1
        while place < len(self.value):
            if value > self.value[place]:
                self.value[place], self.owner[place] = value, owner
            place += place & -place

    def best(self, place: int) -> tuple[float, int]:
        """Over the places below `place`."""
        value, owner = float("-inf"), -1
        while place > 0:
            if self.value[place] > value:
                value, owner = self.value[place], self.owner[place]
            place -= place & -place
        return value, owner


def chain(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Disjoint collinear chains of (position, origin position), those of the greatest score first.

    A chain's score is SEED for its first match; a further one adds the words it covers anew, at most
    SEED, less GAP for each word that the two positions skip on average, or starts a new chain if that is better.
    """
    matches = sorted(matches)
    places = {y: i for i, y in enumerate(sorted({y for _, y in matches}))}
    tree = Fenwick(len(places))
    score, before = [], []
    waiting: list[int] = []
    for i, (x, y) in enumerate(matches):
        # Matches at the same position of the document do not follow each other.
        while waiting and matches[waiting[0]][0] < x:
            j = waiting.pop(0)
            tree.put(places[matches[j][1]], score[j] + GAP * (matches[j][0] + matches[j][1]) / 2, j)
        value, j = tree.best(places[y])
        gain = SEED
        if j >= 0:
            step = min(x - matches[j][0], y - matches[j][1])
            value -= GAP * (x + y) / 2
            gain = min(SEED, step) + GAP * min(SEED, step)
        best = value + gain if j >= 0 and value > 0 else SEED
        score.append(max(best, SEED))
        before.append(j if best > SEED else -1)
        waiting.append(i)
    used = [False] * len(matches)
    chains = []
    for i in sorted(range(len(matches)), key=lambda i: (-score[i], i)):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(matches[i])
            i = before[i]
        if path:
            chains.append(path[::-1])
    return chains


def _common(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places of the words in common of two short sequences, in order (a longest common subsequence)."""
    if not len(a) or not len(b):
        return []
    if len(a) == len(b) and (a == b).all():
        return [(i, i) for i in range(len(a))]
    if len(a) > LONG_GAP or len(b) > LONG_GAP:
        n = min(len(a), len(b))
        return [(i, i) for i in np.flatnonzero(a[:n] == b[:n]).tolist()]
    if len(a) == len(b) == 1:
        return [(0, 0)] if a[0] == b[0] else []
    same = a[:, None] == b[None, :]
    if not same.any():
        return []
    best = np.zeros((len(a) + 1, len(b) + 1), np.int64)
    for i in range(len(a)):
        best[i + 1, 1:] = np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + same[i]))
    found, (i, j) = [], same.shape
    while best[i, j]:
        if best[i - 1, j] == best[i, j]:
            i -= 1
        elif best[i, j - 1] == best[i, j]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.append((i, j))
    return found[::-1]


def _grown(a: np.ndarray, b: np.ndarray) -> list[int]:
    """The places that agree where two sequences are extended from their starts, place by place."""
    n = min(len(a), len(b), MARGIN)
    found: list[int] = []
    for i in np.flatnonzero(a[:n] == b[:n]).tolist():
        if i - (found[-1] if found else -1) - 1 > DROP:
            break
        found.append(i)
    return found


def pairs(x: np.ndarray, y: np.ndarray, path: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Positions in x and in y of the words that agree along a chain, gaps and ends included."""
    x0, y0 = path[0]
    out = [(x0 - 1 - i, y0 - 1 - i) for i in _grown(x[max(0, x0 - MARGIN) : x0][::-1], y[max(0, y0 - MARGIN) : y0][::-1])][::-1]
    lead = 0
    # Most copies agree word for word, from the first match to the last with as many words between in both.
    while lead + 1 < len(path) and path[lead + 1][0] - path[lead + 1][1] == x0 - y0:
        lead += 1
    n = path[lead][0] + SEED - x0
    differ = np.flatnonzero(x[x0 : x0 + n] != y[y0 : y0 + n])
    if len(differ):
        n = int(differ[0])
        while lead and path[lead][0] + SEED - x0 > n:
            lead -= 1
        n = path[lead][0] + SEED - x0
    out += zip(range(x0, x0 + n), range(y0, y0 + n), strict=True)
    at_x, at_y = x0 + n, y0 + n
    for i, j in path[lead + 1 :]:
        # Words between the end of the match before and this one; overlapping matches have none.
        if i > at_x and j > at_y:
            out += [(at_x + p, at_y + q) for p, q in _common(x[at_x:i], y[at_y:j])]
        skip = max(at_x - i, at_y - j, 0)
        out += [(i + k, j + k) for k in range(skip, SEED)]
        at_x, at_y = max(at_x, i + SEED), max(at_y, j + SEED)
    out += [(at_x + i, at_y + i) for i in _grown(x[at_x : at_x + MARGIN], y[at_y : at_y + MARGIN])]
    found = np.array(out, np.int64)
    return found[:, 0], found[:, 1]


def _alike(px: np.ndarray, py: np.ndarray, i: int, j: int) -> float:
    """Share of agreeing words from pair i to pair j."""
    return (j - i + 1) / float(max(px[j] - px[i] + 1, py[j] - py[i] + 1))


def _longest(px: np.ndarray, py: np.ndarray) -> tuple[int, int] | None:
    """First and last pair of the most words of x in which ALIKE of the words agree in both texts."""
    k = np.arange(len(px))
    price = round(ALIKE * 1000)
    # Pairs i to j are alike enough if neither sum falls from before i to after j.
    before = [(1000 * k - price * p).tolist() for p in (px, py)]
    after = [(1000 * (k + 1) - price * (p + 1)).tolist() for p in (px, py)]
    places = sorted(set(before[1]))
    tree = Fenwick(len(places))
    best, found = WORDS - 1, None
    first = sorted(range(len(k)), key=lambda i: before[0][i])
    at = 0
    for j in sorted(range(len(k)), key=lambda j: after[0][j]):
        while at < len(first) and before[0][first[at]] <= after[0][j]:
            i = first[at]
            tree.put(bisect_left(places, before[1][i]), -i, i)
            at += 1
        i = tree.best(bisect_right(places, after[1][j]))[1]
        if 0 <= i <= j and (words := int(px[j] - px[i]) + 1) > best:
            best, found = words, (i, j)
    return found


def _trimmed(px: np.ndarray, py: np.ndarray, i: int, j: int) -> tuple[int, int]:
    """Pairs i to j without ends that only chance words hold: those beyond DROP others from the first or last whole seed."""
    step = np.maximum(np.diff(px[i : j + 1]), np.diff(py[i : j + 1]))
    close = np.concatenate([[0], np.cumsum(step == 1)])
    whole = np.flatnonzero(close[SEED - 1 :] - close[: len(close) - SEED + 1] == SEED - 1)
    if not len(whole):
        return i, j
    a, b = int(whole[0]), int(whole[-1]) + SEED - 1
    straight = np.diff(px[i : j + 1]) == np.diff(py[i : j + 1])
    while a > 0 and step[a - 1] <= DROP + 1 and straight[a - 1]:
        a -= 1
    while b < len(step) and step[b] <= DROP + 1 and straight[b]:
        b += 1
    return i + a, i + b


def align(x: np.ndarray, y: np.ndarray, path: list[tuple[int, int]]) -> list[tuple[int, int, int, int, float]]:
    """The passages along a chain: first and end position in x and in y, and the share of agreeing words.

    Of what agrees along the chain, the longest stretch that is long and alike enough is a passage; then the
    same is asked of what lies before and behind it.
    """
    px, py = pairs(x, y, path)
    out = []
    todo = [(0, len(px))]
    while todo:
        low, high = todo.pop()
        if high <= low or high - low < ALIKE * WORDS:
            continue
        i, j = low, high - 1
        if px[j] - px[i] + 1 < WORDS:
            continue
        if _alike(px, py, i, j) < ALIKE:
            found = _longest(px[low:high], py[low:high])
            if found is None:
                continue
            i, j = low + found[0], low + found[1]
            a, b = _trimmed(px, py, i, j)
            if px[b] - px[a] + 1 >= WORDS and _alike(px, py, a, b) >= ALIKE:
                i, j = a, b
        out.append((int(px[i]), int(px[j]) + 1, int(py[i]), int(py[j]) + 1, _alike(px, py, i, j)))
        todo += [(low, i), (j + 1, high)]
    return sorted(out)


def seeds_of(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """`seeds` of several texts, one after the other: number of seeds of each text, hashes, number of places of each seed, places."""
    sizes = np.array([len(w) for w in texts])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    words = np.concatenate([*texts, np.zeros(SEED + SPAN, np.uint64)])
    found = sequences(words, SEED)
    # All windows of SPAN seeds that lie in one text, and the one shorter window of a shorter text.
    windows = np.where(sizes < SEED, 0, np.maximum(sizes - (SEED + SPAN - 2), 1))
    text = np.repeat(np.arange(len(texts)), windows)
    first = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + starts[text]
    stop = starts[text + 1] - SEED
    at, least = first.copy(), found[first]
    for i in range(1, SPAN):
        value = found[first + i]
        less = (value < least) & (first + i <= stop)
        at[less], least[less] = first[less] + i, value[less]
    # The least of the next window is the same one or a later one.
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
    at, least, text = at[new], least[new], text[new]
    order = np.lexsort((least, text))
    at, least, text = at[order], least[order], text[order]
    lead = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])])) if len(at) else at
    return np.bincount(text[lead], minlength=len(texts)), least[lead], np.diff(np.append(lead, len(at))), at - starts[text]


def _seed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, part (hash of the text), seed, and places of each seed of a document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // BATCH_BYTES
            ends = [*(np.flatnonzero(np.diff(long)) + 1).tolist(), len(batch)]
            for at, end in zip([0, *ends], ends, strict=False):
                some = batch.slice(at, end - at)
                sizes, hashes, times, places = seeds_of(words_hashed(some["text"].to_pylist()))
                of = pa.array(np.repeat(np.arange(len(some)), sizes))
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(times)]).astype(np.int32), pa.array(places.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"].take(of), some["part"].take(of), pa.array(hashes.view(np.int64)), lists], names=["doc_id", "part", "seed", "places"]
                )

    return _texts(docs).mapInArrow(rows, "doc_id bigint, part int, seed bigint, places array<int>")


def _hot_seeds(found: DataFrame) -> DataFrame:
    """Seeds with a share of HOT_SHARE of all rows, among some that have it in one task only.

    What has that share of all rows has it of the rows of some task, so each task names its own: 1 / HOT_SHARE at most.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = [batch["seed"].to_numpy(np.int64) for batch in batches]
        if seen:
            values, times = np.unique(np.concatenate(seen), return_counts=True)
            yield pd.DataFrame({"seed": values[times >= max(2.0, times.sum() * HOT_SHARE)]})

    named = store(found.select("seed").mapInPandas(rows, "seed bigint").distinct())
    total = found.count()
    counted = found.join(F.broadcast(named), "seed").groupBy("seed").agg(F.count(F.lit(1)).alias("times"))
    return store(counted.filter(F.col("times") >= max(2.0, total * HOT_SHARE)).select("seed"))


def _held(found: DataFrame) -> DataFrame:
    """The rows of seeds that several have, with the first and the last of these and their number.

    Rows of other than hot seeds move once, to those of the same seed; hot ones stay where they are.
    """
    holder = F.struct("doc_id", "part", F.get("places", F.lit(0)).alias("place"))
    values = {"first": F.min(holder), "last": F.max(holder), "times": F.count(F.lit(1))}
    hot = _hot_seeds(found)
    ends = found.join(F.broadcast(hot), "seed").groupBy("seed").agg(*[c.alias(n) for n, c in values.items()])
    same = Window.partitionBy("seed")
    cold = found.join(F.broadcast(hot), "seed", "left_anti").withColumns({n: c.over(same) for n, c in values.items()})
    return found.join(F.broadcast(ends), "seed").unionByName(cold).filter("times > 1")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.hash("text").alias("part"), F.col("text").cast("binary").alias("text"))


def _chains(groups: DataFrame) -> DataFrame:
    """Chains of at least half the words of a passage, with their matches."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                packed = np.asarray(row.matches)
                for path in chain(list(zip((packed >> 32).tolist(), (packed & 0xFFFFFFFF).tolist(), strict=True))):
                    if path[-1][0] + SEED - path[0][0] >= WORDS // 2:
                        out.append((row.doc_id, row.part, row.origin_id, row.origin_part, [p[0] for p in path], [p[1] for p in path]))
            frame = pd.DataFrame(out, columns=["doc_id", "part", "origin_id", "origin_part", "at", "origin_at"])
            yield frame.astype({"doc_id": "Int64", "origin_id": "Int64"})

    return groups.mapInPandas(rows, "doc_id bigint, part int, origin_id bigint, origin_part int, at array<int>, origin_at array<int>")


def _sieved(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """The rows with a key in `needed`, and a few others: those whose key has a bit that is set by one of them.

    The bits are two bytes for each key needed and SIEVE_ROWS * SIEVE_ROW at most, so they are broadcast in place of the keys.
    """
    n = min(SIEVE_ROWS, needed.count() * SIEVE_BITS // SIEVE_ROW + 1)
    bit = F.pmod(F.xxhash64("key"), F.lit(n * SIEVE_ROW))
    row, place = F.floor(bit / SIEVE_ROW).alias("row"), F.pmod(bit, F.lit(SIEVE_ROW)).alias("place")
    bits = needed.groupBy(row).agg(F.bitmap_construct_agg(place).alias("bits"))
    marked = rows.withColumns({"row": row, "place": place}).join(F.broadcast(bits), "row")
    return marked.filter(F.expr("shiftright(cast(conv(hex(substring(bits, cast(place div 8 as int) + 1, 1)), 16, 10) as int), cast(place % 8 as int)) % 2 = 1")).drop("row", "place", "bits")


def _words(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """key and hashes (8 bytes for each word, one after the other) of the documents with a key in `needed`."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.iloc[at : at + 256]
                yield pd.DataFrame({"key": some["key"], "hashes": [w.tobytes() for w in words_hashed(list(some["text"]))]})

    parts = []
    for turn in range(TURNS):
        # To be joined, the texts move: only those that may have a key in `needed`, and in turns, so that less of them lies on disk.
        of = lambda doc_id: F.pmod(F.xxhash64(doc_id), F.lit(TURNS)) == turn  # noqa: B023, E731
        texts = _texts(docs.filter(of("doc_id"))).select(_key("doc_id", "part"), "text")
        # Repeated rows have one key and one text.
        sought = needed.filter(of("key.id"))
        texts = _sieved(texts, sought).join(sought, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
        parts.append(store(texts.mapInPandas(rows, "key struct<id:bigint,part:int>, hashes binary")))
        _drop_shuffles(docs.sparkSession)
    return reduce(DataFrame.unionByName, parts)


def _key(doc_id: str, part: str) -> Column:
    return F.struct(F.col(doc_id).alias("id"), F.col(part).alias("part")).alias("key")


def _with_words(chains: DataFrame, words: DataFrame, key: Column, at: str, out: str, total: int) -> DataFrame:
    """Add `out`: the words of a chain and MARGIN around it, cut from its document's, and `out`_start, their position.

    A document with a share of HOT_SHARE of all chains is cut to them in as many copies: its chains are dealt
    by a hash over these, so that no task has more. There are at most 1 / HOT_SHARE such documents.
    """
    chains = chains.withColumn("key", key)
    share = max(2.0, total * HOT_SHARE)
    hot = chains.groupBy("key").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") >= share)
    hot = F.broadcast(store(hot.select("key", F.ceil(F.col("times") / share).cast("int").alias("copies"))))
    copies = F.coalesce("copies", F.lit(1))
    dealt = chains.join(hot, "key", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id", "part", "origin_id", "at"), copies).cast("int")).drop("copies")
    copied = words.join(hot, "key", "left").select("key", "hashes", F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"))
    start = F.greatest(F.get(at, F.lit(0)) - MARGIN, F.lit(0))
    length = F.element_at(at, -1) + SEED + MARGIN - start
    # Whatever the width of the join, a row goes on with its stretch only.
    return dealt.join(copied, ["key", "salt"]).withColumns(
        {out: F.substring("hashes", 8 * start + 1, 8 * length), f"{out}_start": start}
    ).drop("hashes", "key", "salt")


def _aligned(chains: DataFrame, docs: DataFrame) -> DataFrame:
    """The passages of chains."""
    here, there = _key("doc_id", "part"), _key("origin_id", "origin_part")
    needed = store(chains.select(here).unionByName(chains.select(there)).distinct())
    words = _words(docs, needed)
    total = chains.count()
    rows = _with_words(chains, words, here, "at", "words", total)
    rows = _with_words(rows, words, there, "origin_at", "origin_words", total)

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                x, y = np.frombuffer(r.words, np.uint64), np.frombuffer(r.origin_words, np.uint64)
                path = list(zip((r.at - r.words_start).tolist(), (r.origin_at - r.origin_words_start).tolist(), strict=True))
                for a, b, c, d, alike in align(x, y, path):
                    out.append((r.doc_id, r.part, r.words_start + a, r.words_start + b, r.origin_id, r.origin_part, r.origin_words_start + c, r.origin_words_start + d, alike))
            frame = pd.DataFrame(out, columns=["doc_id", "part", "first_word", "end_word", "origin_id", "origin_part", "origin_first", "origin_end", "alike"])
            yield frame.astype({"doc_id": "Int64", "origin_id": "Int64"})

    found = store(
        rows.mapInPandas(
            aligned,
            "doc_id bigint, part int, first_word int, end_word int, origin_id bigint, origin_part int, origin_first int, origin_end int, alike double",
        )
    )
    _done_with(words, needed)
    return found


def _long_enough(groups: DataFrame) -> DataFrame:
    """Groups that may hold a chain: several matches, half a passage apart."""
    spread = F.shiftright(F.element_at("matches", -1), 32) - F.shiftright(F.get("matches", F.lit(0)), 32)
    return groups.filter(F.size("matches") > 1).filter(spread + SEED >= WORDS // 2)


def _covered(passages: DataFrame) -> DataFrame:
    """key and spans (first and end position) of the documents that have a copy or an origin of one."""
    spans = passages.select("doc_id", "part", F.struct(F.col("first_word").alias("first"), F.col("end_word").alias("stop")).alias("span")).unionByName(
        passages.select(F.col("origin_id").alias("doc_id"), F.col("origin_part").alias("part"), F.struct(F.col("origin_first").alias("first"), F.col("origin_end").alias("stop")).alias("span"))
    )
    # The copies of a passage have one origin; its spans there are few different ones, but may be many in all.
    return spans.distinct().groupBy(_key("doc_id", "part")).agg(F.collect_list("span").alias("spans"))


def islands(places: np.ndarray) -> np.ndarray:
    """Which of the sorted places may lie in a chain of half a passage, wherever the matches stand in the other document.

    A chain that goes from one place to the next one needs a score above GAP * (x + y) / 2, of which x are the words between
    the two here, and y, those there, counts as SEED: so the score grows most. If even that is not enough, no chain goes on there.
    """
    if not len(places):
        return np.zeros(0, bool)
    gaps = np.diff(places)
    gains = np.where(gaps < SEED, (1 + GAP) * gaps - GAP * gaps, (1 + GAP) * SEED - GAP * (gaps + SEED) / 2)
    cuts, score, at = [0], float(SEED), 0
    # No chain ends at a lesser gap than this one.
    for k in np.flatnonzero(GAP * (gaps + SEED) / 2 >= SEED).tolist():
        score += gains[at:k].sum()
        if score <= GAP * (gaps[k] + SEED) / 2:
            cuts.append(k + 1)
            score = float(SEED)
        else:
            score = max(float(SEED), score + gains[k])
        at = k + 1
    ends = np.array([*cuts[1:], len(places)])
    return np.repeat(places[ends - 1] - places[cuts] + SEED >= WORDS // 2, ends - cuts)


def beside(places: np.ndarray, seeds: np.ndarray, i: np.ndarray, j: np.ndarray, both: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For couples of a seed with itself (i, j): the seed with each other one at most REACH words from one of the two.

    Only places that lie in a couple count. Hashes, indices of both seeds, and if the couple is free.
    """
    own = np.flatnonzero(seeds[i] == seeds[j])
    if not len(own):
        return i[:0].astype(np.int64), i[:0], j[:0], both[:0]
    used = np.unique(np.concatenate([i, j]))
    free = np.zeros(len(places), bool)
    for ends in (i, j):
        free[ends[own]] |= both[own]
    # A couple is free if it is anywhere.
    values, of = np.unique(seeds, return_inverse=True)
    some = np.zeros(len(values), bool)
    np.logical_or.at(some, of, free)
    at = np.unique(np.concatenate([i[own], j[own]]))
    low, high = np.searchsorted(places[used], places[at] - REACH), np.searchsorted(places[used], places[at] + REACH, side="right")
    n = high - low
    one = np.repeat(at, n)
    two = used[np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
    other = seeds[one] != seeds[two]
    one, two = one[other], two[other]
    return mix(mix(seeds[one]) + seeds[two]).view(np.int64), one, two, some[of[one]]


def couples(places: np.ndarray, seeds: np.ndarray, many: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Couples of seeds at sorted places, NEAR to FAR words apart, of which one has more than two holders.

    Their hashes, the indices of both seeds, and if both are free.
    """
    low, high = np.searchsorted(places, places + NEAR), np.searchsorted(places, places + FAR, side="right")
    n = high - low
    i = np.repeat(np.arange(len(places)), n)
    j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    open_ = many[i] | many[j]
    i, j = i[open_], j[open_]
    return mix(seeds[i] * np.uint64(0x9E3779B97F4A7C15) + seeds[j]).view(np.int64), i, j, free[i] & free[j]


def _drop_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffles that no plan needs any more: it does when the driver collects garbage, which it would seldom do of itself."""
    spark._jvm.System.gc()


def _done_with(*stored: DataFrame) -> None:
    """Delete stored tables that nothing will read again, and the shuffles that no plan needs any more."""
    spark = stored[0].sparkSession
    for folder in {file.rsplit("/", 1)[0] for table in stored for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _drop_shuffles(spark)


def _couples(held: DataFrame, spans: DataFrame, free_only: bool) -> DataFrame:
    """The couples of each document, each once: its hash, if it is free somewhere, its places, and if documents meet by it.

    With `free_only` those that are, with all free places of either seed, where a chain may be; else all, with the first place.
    By couples of a seed with itself, as any loop of a word has them, documents do not meet: their places, FAR or NEAR apart, cannot
    begin a chain. They meet by what lies beside these seeds, of which the places are not told.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, out, lists = [], [], []
            for r in batch.itertuples(index=False):
                sizes.append(0)
                places = np.asarray(r.place, np.int64)
                inside = np.zeros(int(places[-1]) + 2, np.int64)
                if r.first is not None:
                    np.add.at(inside, np.minimum(r.first, places[-1] + 1), 1)
                    np.add.at(inside, np.minimum(r.stop, places[-1] + 1), -1)
                free = np.cumsum(inside)[places] == 0
                if free_only and not free.any():
                    continue
                seeds = np.asarray(r.seed, np.int64).view(np.uint64)
                some = free if free_only else slice(None)
                places, seeds = places[some], seeds[some]
                found, i, j, both = couples(places, seeds, np.asarray(r.many, bool)[some], free[some])
                if free_only and len(found):
                    used = np.unique(np.concatenate([i, j]))
                    able = np.zeros(len(places), bool)
                    able[used] = islands(places[used])
                    found, i, j, both = (c[able[i] | able[j]] for c in (found, i, j, both))
                if not len(found):
                    continue
                signed = seeds.view(np.int64)
                for meets, (found, i, j, both) in ((False, (found, i, j, both)), (True, beside(places, seeds, i, j, both))):  # noqa: B020
                    if not len(found):
                        continue
                    order = np.argsort(found, kind="stable")
                    first = np.flatnonzero(np.concatenate([[True], np.diff(found[order]) != 0]))
                    lead = order[first]
                    if meets:
                        lists += [(places[:0], places[:0])] * len(lead)
                    elif free_only:
                        parts = np.split(order, first[1:])
                        lists += [(places[np.unique(i[part])], places[np.unique(j[part])]) for part in parts]
                    else:
                        lists += zip(places[i[lead]][:, None], places[j[lead]][:, None], strict=True)
                    sizes[-1] += len(lead)
                    one, two = signed[i[lead]], signed[j[lead]]
                    out.append((found[lead], np.logical_or.reduceat(both[order], first), one, two, one != two))
            if out:
                columns = dict(zip(("couple", "free", "one", "two", "meets"), map(np.concatenate, zip(*out, strict=True)), strict=True))
                of = {"doc_id": batch["doc_id"].array.repeat(sizes), "part": np.repeat(batch["part"].to_numpy(np.int32), sizes)}
                frame = pd.DataFrame(of | columns | {"at": [x for x, _ in lists], "further": [y for _, y in lists]})
                yield frame[["couple", "doc_id", "part", "free", "one", "two", "meets", "at", "further"]]

    at = F.explode("places").alias("place")
    seen = held.select("doc_id", "part", "seed", (F.col("times") > 2).alias("many"), at)
    seen = seen.groupBy("doc_id", "part").agg(F.sort_array(F.collect_set(F.struct("place", "seed", "many"))).alias("s"))
    seen = seen.withColumn("key", _key("doc_id", "part")).join(spans, "key", "left")
    columns = [F.col(f"s.{c}").alias(c) for c in ("place", "seed", "many")] + [F.col(f"spans.{c}").alias(c) for c in ("first", "stop")]
    return seen.select("doc_id", "part", *columns).mapInPandas(
        rows, "couple bigint, doc_id bigint, part int, free boolean, one bigint, two bigint, meets boolean, at array<int>, further array<int>"
    )


def _rest(held: DataFrame, spans: DataFrame) -> DataFrame:
    """Groups of matches of all that is in no span with every holder of two of its seeds, NEAR to FAR words apart.

    Of two documents that both have a couple of seeds free, the later one is the copy.
    """
    free = store(_couples(held, spans, True))
    seeds_left = store(free.select(F.explode(F.array("one", "two")).alias("seed")).distinct())
    there = store(_couples(held.join(seeds_left, "seed", "left_semi"), spans, False).join(free.select("couple").distinct(), "couple", "left_semi"))
    there = there.select("couple", "meets", "one", "two", F.col("doc_id").alias("origin_id"), F.col("part").alias("origin_part"), F.col("free").alias("free_there"), F.get("at", F.lit(0)).alias("y"), F.get("further", F.lit(0)).alias("z"))
    here, origin = F.struct("doc_id", "part"), F.struct(F.col("origin_id").alias("doc_id"), F.col("origin_part").alias("part"))
    ordered = (origin < here) | ((origin > here) & ~F.col("free_there"))
    met = free.filter("meets").select("couple", "doc_id", "part").join(there.filter("meets"), "couple").filter(ordered)
    # Documents meet without their places, of which a loop of words has very many: these come when it is known that a chain can begin.
    ends = ["doc_id", "part", "origin_id", "origin_part"]
    pairs = store(met.groupBy(*ends).agg(F.collect_list(F.struct("couple", "y", "z")).alias("met")))
    # Of those that have met, also the couples of a seed with itself count.
    own = free.filter("one = two").groupBy(_key("doc_id", "part")).agg(F.collect_list("couple").alias("own"))
    alone = there.filter("one = two").groupBy(F.struct(F.col("origin_id").alias("id"), F.col("origin_part").alias("part")).alias("there"))
    alone = alone.agg(F.collect_list(F.struct("couple", "y", "z", "free_there")).alias("alone"))
    pairs = pairs.withColumns({"key": F.struct(F.col("doc_id").alias("id"), "part"), "there": F.struct(F.col("origin_id").alias("id"), F.col("origin_part").alias("part"))})
    pairs = pairs.join(own, "key", "left").join(alone, "there", "left")
    both = F.filter("alone", lambda c: F.array_contains("own", c["couple"]) & ((origin < here) | ((origin > here) & ~c["free_there"])))
    both = F.transform(both, lambda c: F.struct(c["couple"].alias("couple"), c["y"].alias("y"), c["z"].alias("z")))
    # Coalesced, as only some have such couples.
    told = F.filter("met", lambda c: c["y"].isNotNull())
    pairs = pairs.select(*ends, F.coalesce(F.concat(told, both), told).alias("met"))
    y = F.array_sort(F.array_distinct(F.concat("met.y", "met.z")))
    pairs = store(pairs.filter(F.exists(F.zip_with(y, F.slice(y, 2, F.size(y)), lambda a, b: b - a), lambda gap: gap <= REACH)))
    met = pairs.select(*ends, F.inline("met"))
    free = free.select("couple", F.col("doc_id").alias("id"), F.col("part").alias("of"), "at", "further")
    met = met.join(free, (met["couple"] == free["couple"]) & met["doc_id"].eqNullSafe(free["id"]) & (met["part"] == free["of"]))
    packed = lambda y: lambda x: F.shiftleft(x.cast("bigint"), 32).bitwiseOR(F.col(y).cast("bigint"))
    found = met.select(*ends, F.explode(F.concat(F.transform("at", packed("y")), F.transform("further", packed("z")))).alias("match"))
    return found.groupBy(*ends).agg(F.sort_array(F.collect_set("match")).alias("matches"))


def _united(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and stops of the stretches that spans cover together."""
    starts: list[int] = []
    stops: list[int] = []
    for first, stop in sorted(spans):
        if stops and first <= stops[-1]:
            stops[-1] = max(stops[-1], stop)
        else:
            starts.append(first)
            stops.append(stop)
    return starts, stops


def covering(spans: list[tuple[int, int, int]]) -> list[int | None]:
    """For each passage of a document (first, stop, origin): the least origin, less than its own, whose passages together cover it."""
    of: dict[int, list[tuple[int, int]]] = {}
    for first, stop, origin in spans:
        of.setdefault(origin, []).append((first, stop))
    united = [(origin, *_united(of[origin])) for origin in sorted(of)]
    out: list[int | None] = []
    for first, stop, own in spans:
        by = None
        for origin, starts, stops in united:
            if origin >= own:
                break
            k = bisect_right(starts, first) - 1
            if k >= 0 and stops[k] >= stop:
                by = origin
                break
        out.append(by)
    return out


def _linked(passages: DataFrame, others: DataFrame) -> DataFrame:
    """The passages without those that they and others imply: there, both a passage and its origin are copies of an earlier origin.

    What was covered stays so, and all documents that hold a passage stay linked, but not each with each: the links that replace
    one have an earlier origin than it.
    """

    columns = passages.columns

    def rows(doc: pd.DataFrame) -> pd.DataFrame:
        # A null id comes first.
        origins = list(zip(doc["origin_id"].notna(), doc["origin_id"].fillna(0), doc["origin_part"], strict=True))
        order = {o: i for i, o in enumerate(sorted(set(origins)))}
        back = {order[o]: k for k, o in enumerate(origins)}
        by = covering(list(zip(doc["first_word"], doc["end_word"], map(order.get, origins), strict=True)))
        at = [back.get(b, 0) for b in by]
        found = doc.assign(implied=[b is not None for b in by], by_id=doc["origin_id"].astype("Int64").array.take(at), by_part=doc["origin_part"].to_numpy()[at])
        found = found.astype({"doc_id": "Int64", "origin_id": "Int64"})
        return found.loc[found["new"], [*columns, "implied", "by_id", "by_part"]]

    every = passages.withColumn("new", F.lit(True)).unionByName(others.withColumn("new", F.lit(False)))
    here = every.withColumn("key", _key("doc_id", "part")).join(passages.select(_key("doc_id", "part")).distinct(), "key", "left_semi").drop("key")
    schema = f"{', '.join(f'{name} {kind}' for name, kind in passages.dtypes)}, implied boolean, by_id bigint, by_part int"
    # Few bytes, but a call for each document: these must not end up in one task.
    here = here.repartition(int(here.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "part")
    found = here.groupBy("doc_id", "part").applyInPandas(rows, schema)
    span = F.struct(F.col("first_word").alias("first"), F.col("end_word").alias("stop"))
    # The stretches that the passages of one origin cover together.
    last = lambda done: F.element_at(done, -1)
    unite = lambda done, s: F.when((F.size(done) > 0) & (last(done)["stop"] >= s["first"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last(done)["first"].alias("first"), F.greatest(last(done)["stop"], s["stop"]).alias("stop"))))).otherwise(F.concat(done, F.array(s)))
    copies = every.groupBy(F.col("doc_id").alias("id"), F.col("part").alias("of"), F.col("origin_id").alias("from_id"), F.col("origin_part").alias("from_part")).agg(F.sort_array(F.collect_list(span)).alias("spans"))
    copies = copies.withColumn("spans", F.aggregate("spans", F.slice("spans", 1, 0), unite))
    same = F.col("origin_id").eqNullSafe(F.col("id")) & (F.col("origin_part") == F.col("of")) & F.col("by_id").eqNullSafe(F.col("from_id")) & (F.col("by_part") == F.col("from_part"))
    inside = F.exists("spans", lambda s: (s["first"] <= F.col("origin_first")) & (s["stop"] >= F.col("origin_end")))
    return found.join(copies, same & F.col("implied") & inside, "left_anti").select(*columns)


def passages(docs: DataFrame) -> DataFrame:
    """One row for each repeated passage: doc_id, first_word, end_word, origin_id, origin_first, origin_end, alike."""
    found = store(_seed_rows(docs))
    held = store(_held(found))
    _done_with(found)
    # The last holder is another one than the first, and of use, only if there is a third.
    others = F.when(F.col("times") > 2, F.array("first", "last")).otherwise(F.array("first"))
    matches = (
        held.select("doc_id", "part", "places", F.posexplode(others).alias("turn", "origin"))
        .filter((F.col("doc_id").eqNullSafe(F.col("origin.doc_id")) & (F.col("part") == F.col("origin.part"))) == F.lit(False))
        .select("doc_id", "part", "turn", "origin", F.explode("places").alias("place"))
        # Position here and in the origin, in one number.
        .select(
            "doc_id", "part", "turn", F.col("origin.doc_id").alias("origin_id"), F.col("origin.part").alias("origin_part"),
            F.shiftleft(F.col("place").cast("bigint"), 32).bitwiseOR(F.col("origin.place").cast("bigint")).alias("match"),
        )
    )
    ends = ["doc_id", "part", "turn", "origin_id", "origin_part"]
    groups = store(_long_enough(matches.groupBy(*ends).agg(F.sort_array(F.collect_set("match")).alias("matches"))))
    firsts = _aligned(store(_chains(groups.filter("turn = 0"))), docs)
    # What is a copy or an origin by now is done with.
    spans = _covered(firsts)
    place = lambda m: F.shiftright(m, 32)
    free = F.filter("matches", lambda m: ~F.exists("spans", lambda s: (place(m) >= s["first"]) & (place(m) < s["stop"])))
    rest = groups.filter("turn = 1").withColumn("key", _key("doc_id", "part")).join(spans, "key", "left").withColumn("matches", F.when(F.col("spans").isNull(), F.col("matches")).otherwise(free))
    lasts = _aligned(store(_chains(_long_enough(rest.drop("key", "spans")))), docs)
    found = firsts.unionByName(lasts)
    # What neither the first nor the last holder has whole.
    rest = store(_chains(_long_enough(_rest(held, store(_covered(found))))))
    return found.unionByName(_linked(_aligned(rest, docs), found)).drop("part", "origin_part")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))


QUERIES = {"op8_substring_dedup": op8_substring_dedup}
SQL: dict[str, str] = {}
