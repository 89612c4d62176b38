"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items make one automaton. The words of a document run through
it: the state and the length of the longest suffix that occurs in an item are known at every word.
Where that length reaches a window (`WINDOW` words, or a whole item of fewer), its words are
hit. Hit words make spans; spans that are long enough, or a document that is hit enough,
are removed. A whole short item is a span whatever its length.

Texts are read once, whatever the size of the benchmark, and do not move. Items are cut into pieces that
overlap by a word less than a window, so that each window is in one piece; pieces are dealt by hash into blocks
of about BLOCK_WORDS words. Tasks build an automaton for each block and store it in the shared
folder; Spark hands the files to its executors, as files, and the scanning tasks run each batch of texts through one
automaton after the other. No text of an item passes through the driver's memory, and a task holds at most HELD automata.
The files stay listed in the session until it ends.

Defined cases: null and empty texts, and texts without words, have no words, hits or items. Items
without words are ignored; an item without item_id is found but not listed. Repeated rows are treated
alike. An empty benchmark hits nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import unquote

import pandas as pd
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm.common import fresh, store, table

WINDOW = 10
# Words of a block, on average, and places where a window of a piece can begin.
BLOCK_WORDS, PIECE_WORDS = 100_000, 2_000
# Up to this number a worker keeps the automata; of more it reads one at a time for each batch of texts.
HELD = 2
# Limits of the removal: words of a span, and the share of a document's words that may be hit.
SPAN_WORDS, COVERAGE = 10, 0.0

# The contract's words: runs of digits, lower-case letters and all bytes from 0x80.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
FOUND = "n_words bigint, spans array<struct<first:int,stop:int,short:boolean>>, items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


class Automaton:
    """Suffix automaton of several word sequences, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.link, self.longest = [-1], [0]
        self.step: dict[int, int] = {}  # state and word, as one number, to the next state
        self.out: list[list[int]] = [[]]  # the words that lead on from a state
        for _, words in items:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        self.base = max(1, len(self.vocabulary))
        for _, words in items:
            state = 0
            for w in words:
                state = self._extend(state, self.vocabulary[w])
        self._windows(items)
        del self.out

    def _put(self, state: int, word: int, to: int) -> None:
        key = state * self.base + word
        if key not in self.step:
            self.out[state].append(word)
        self.step[key] = to

    def _state(self, longest: int, link: int) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.out.append([])
        return len(self.longest) - 1

    def _split(self, state: int, word: int, to: int) -> int:
        """The state of the strings of `to` that are no longer than `state` and `word`."""
        if self.longest[to] == self.longest[state] + 1:
            return to
        short = self._state(self.longest[state] + 1, self.link[to])
        for w in self.out[to]:
            self._put(short, w, self.step[to * self.base + w])
        self.link[to] = short
        while state >= 0 and self.step.get(state * self.base + word) == to:
            self._put(state, word, short)
            state = self.link[state]
        return short

    def _extend(self, state: int, word: int) -> int:
        """The state of the current sequence after one more word."""
        if (to := self.step.get(state * self.base + word)) is not None:
            return self._split(state, word, to)
        new, at = self._state(self.longest[state] + 1, 0), state
        while at >= 0 and at * self.base + word not in self.step:
            self._put(at, word, new)
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, word, self.step[at * self.base + word])
        return new

    def _windows(self, items: list[tuple[str | None, list[bytes]]]) -> None:
        """For each state: the least match length that ends a window, and windows with their items."""
        own: dict[int, dict[int, set]] = {}  # windows by the state of which they are a string
        for item, words in items:
            size = min(self.window, len(words))
            codes = [self.vocabulary[w] for w in words]
            for state, length in self._walk(codes):
                if size and length >= size:
                    while self.longest[self.link[state]] >= size:
                        state = self.link[state]
                    if size == self.window or length == len(words):
                        own.setdefault(state, {}).setdefault(size, set()).add(item)
        none = self.window + 1 << 30
        self.least = [none] * len(self.link)
        self.ends: list[tuple] = [()] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.longest.__getitem__):
            up = self.ends[self.link[state]] if state else ()
            mine = tuple((size, tuple(sorted(x for x in found if x is not None))) for size, found in own.get(state, {}).items())
            self.ends[state] = up + mine if mine else up
            if self.ends[state]:
                self.least[state] = min(size for size, _ in self.ends[state])

    def _walk(self, codes: list[int]) -> Iterator[tuple[int, int]]:
        state = length = 0
        step, base, link, longest = self.step, self.base, self.link, self.longest
        for word in codes:
            if word < 0:
                state = length = 0
            else:
                to = step.get(state * base + word)
                while to is None and state:
                    state = link[state]
                    length = longest[state]
                    to = step.get(state * base + word)
                if to is None:
                    length = 0
                else:
                    state = to
                    length += 1
            yield state, length

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words, merged and in order, and the items whose windows occur."""
        spans, items = self.search(words)
        return [(first, stop) for first, stop, _ in spans], items

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int, bool]], set[str]]:
        """As `find`; of each span also if it holds a whole item that is shorter than a window."""
        spans: list[tuple[int, int, bool]] = []
        items: set[str] = set()
        least, known = self.least, self.vocabulary.get
        at = 0
        for state, length in self._walk([known(w, -1) for w in words]):
            at += 1
            if length >= least[state]:
                ended = [(size, found) for size, found in self.ends[state] if size <= length]
                first = at - max(size for size, _ in ended)
                short = any(size < self.window for size, _ in ended)
                while spans and spans[-1][1] >= first:
                    before = spans.pop()
                    first, short = min(first, before[0]), short or before[2]
                spans.append((first, at, short))
                for _, found in ended:
                    items.update(found)
        return spans, items


def _pieces(benchmark: DataFrame) -> DataFrame:
    """item, words (joined by blanks) and n: items with words, long ones in overlapping pieces, equal pieces once. Stored."""
    step, overlap = PIECE_WORDS, WINDOW - 1

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"], strict=True):
                words = words_of(text)
                for at in range(0, max(len(words) - overlap, 1), step):
                    if piece := words[at : at + step + overlap]:
                        rows.append((item, b" ".join(piece), len(piece)))
            yield pd.DataFrame(rows, columns=["item", "words", "n"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).distinct()
    return store(items.mapInPandas(cut, "item string, words binary, n bigint").distinct())


def _automata(benchmark: DataFrame) -> tuple[tuple[str, ...], int]:
    """Names of the files of automata, as executors have them, and the number of blocks."""
    pieces = _pieces(benchmark)
    blocks = math.ceil((pieces.agg(F.sum("n")).first()[0] or 0) / BLOCK_WORDS)

    def build(block: pd.DataFrame) -> pd.DataFrame:
        automaton = Automaton([(i, w.split()) for i, w in zip(block["item"], block["words"], strict=True)])
        return pd.DataFrame({"automaton": [pickle.dumps(automaton)]})

    of_block = pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, blocks))))
    files = [unquote(f) for f in store(of_block.groupBy("block").applyInPandas(build, "automaton binary")).inputFiles()]
    for f in files:
        benchmark.sparkSession.sparkContext.addFile(f)
    return tuple(f.rsplit("/", 1)[-1] for f in files), blocks


def _read(files: tuple[str, ...]) -> Iterator[Automaton]:
    """The automata of these files, or an empty one if there are none."""
    empty = True
    for name in files:
        with pq.ParquetFile(SparkFiles.get(name)) as file:
            for batch in file.iter_batches(batch_size=1):
                empty = False
                yield pickle.loads(batch.column(0)[0].as_py())
    if empty:
        yield Automaton([])


@lru_cache(1)
def _held(files: tuple[str, ...]) -> list[Automaton]:
    return list(_read(files))


def find_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` (whose columns must not be named like these) with n_words, spans of hit words, and items."""
    files, blocks = _automata(benchmark)
    held = blocks <= HELD

    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        counts, spans, items = [0] * len(texts), [[] for _ in texts], [set() for _ in texts]
        for automaton in _held(files) if held else _read(files):
            for i, text in enumerate(texts):
                words = words_of(text)
                counts[i] = len(words)
                more, named = automaton.search(words)
                spans[i] = merged(spans[i] + more) if spans[i] and more else spans[i] or more
                items[i] |= named
        rows = [
            (n, [{"first": a, "stop": b, "short": c} for a, b, c in of], sorted(named))
            for n, of, named in zip(counts, spans, items, strict=True)
        ]
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return docs.withColumn("found", found(F.col("text").cast("binary"))).select(*docs.columns, "found.*")


def merged(spans: list[tuple[int, int, bool]]) -> list[tuple[int, int, bool]]:
    """Spans in order, with those that touch or overlap made one."""
    out: list[tuple[int, int, bool]] = []
    for first, stop, short in sorted(spans):
        if out and out[-1][1] >= first:
            before = out.pop()
            first, stop, short = before[0], max(stop, before[1]), short or before[2]
        out.append((first, stop, short))
    return out


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0), lambda n, s: n + s["stop"] - s["first"]).cast("bigint")


def decontaminate(docs: DataFrame, benchmark: DataFrame, span_words: int = SPAN_WORDS, coverage: float = COVERAGE) -> DataFrame:
    """`docs` without what benchmark items occur in.

    A document goes if more than `coverage` of its words are in hit spans of `span_words` or more, or in spans that
    hold a whole item of fewer words than a window. With
    coverage=1 none goes; the spans are cut out of the texts instead, from the first letter of a
    span's first word to the last one of its last word. The columns stay.
    """
    whole = fresh(docs, "whole")
    found = find_spans(docs.select(F.struct(*docs.columns).alias(whole), "text", "doc_id"), benchmark)
    counted = F.filter("spans", lambda s: (s["stop"] - s["first"] >= span_words) | s["short"])
    found = found.withColumn("spans", counted)
    kept = found.filter(hit_words() <= F.lit(coverage) * F.col("n_words"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, s) for t, s in zip(texts, spans, strict=True)])

    text = F.when(F.size("spans") > 0, cut(F.col("text").cast("binary"), "spans")).otherwise(F.col("text"))
    kept = kept.withColumn("text", text) if coverage > 0 else kept
    return kept.select(*[F.col("text") if c == "text" else F.col(f"{whole}.`{c}`").alias(c) for c in docs.columns])


def _cut(text: bytes | None, spans: list) -> str | None:
    if text is None or not len(spans):
        return None if text is None else text.decode("utf-8", "replace")
    import re

    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_WORDS))]
    out, at = [], 0
    for s in spans:
        out.append(text[at : places[s["first"]][0]])
        at = places[s["stop"] - 1][1]
    return b"".join([*out, text[at:]]).decode("utf-8", "replace")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each document."""
    found = find_spans(docs.select("doc_id", "text"), benchmark)
    listed = F.array_join(F.sort_array("items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op4_decontamination": op4_decontamination}
SQL = {
    "op4_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
        ), b AS (
            SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
        ), s AS (
            SELECT item, words, least(len(words), 10) AS size FROM b WHERE len(words) > 0
        ), w AS (
            SELECT DISTINCT item, size, array_to_string(words[p : p + size - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS p FROM s)
        ), o AS (
            SELECT doc_id, size, p, array_to_string(words[p : p + size - 1], ' ') AS win
            FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS p
                  FROM d, (SELECT DISTINCT size FROM s))
        ), h AS (
            SELECT doc_id, item, size, p FROM o JOIN w USING (size, win)
        ), n AS (
            SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS pos FROM h) GROUP BY doc_id
        ), i AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)"""
}
