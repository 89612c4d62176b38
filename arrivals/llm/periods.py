"""Runs of periodic words, found with string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are identical) and at least
EXPONENT times q words, which no neighbouring word extends. Loops of a crawler, of a generator or of a
broken page are runs; `collapse` keeps the first period of each.

Small periods, below SMALL, are read off: words are compared with those q places on, and stretches that
agree for long enough are highly periodic regions. Larger ones are proposed by synchronising sets at
the scales t = SMALL, 2 SMALL, 4 SMALL, ... for periods from t to 2t - 1: a place i is in the set if of the hashes of
the t words from each of i, ..., i + t the least is at i or at i + t. This depends on the 2t words from i
alone, so the set cuts equal contexts at equal places. Places whose t words have a period of at most
t/EXPONENT, known from the scales below, count for no minimum; they would fill the set. Any t
successive words that start a run of period q >= t hold a place of the set, and its context comes again q
words on, inside the run: neighbours with equal contexts propose their distance as a period. A proposal
is then extended word by word as far as it holds, so hashes decide nothing alone.

One text is handled by one task, in time of about n log n and memory of about n words; texts do not
move, and none is cut. Texts are handled together up to TOGETHER words.

Defined cases: null and empty texts, and texts without words, have no runs and collapse to an empty
text. Repeated rows are treated alike. An empty table gives an empty result; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm.common import WORD, fresh, table
from arrivals.llm.hashing import mix

# A run: least words, least number of periods in it.
WORDS, EXPONENT = 6, 4
# Periods below are compared directly; words of texts handled together.
SMALL, TOGETHER = 8, 1 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
_NONE = np.iinfo(np.uint64).max

Run = tuple[int, int, int]


def _stretches(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of True begin and end."""
    change = np.diff(true.view(np.int8), prepend=0, append=0)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of the `size` values from each place on; places beyond the end count for nothing."""
    n = len(x)
    blocks = np.full(-(-(n + size) // size) * size, _NONE, np.uint64)
    blocks[:n] = x
    blocks = blocks.reshape(-1, size)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[size - 1 : n + size - 1])


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """The values `by` places on, 0 beyond the end."""
    out = np.zeros_like(x)
    out[: max(0, len(x) - by)] = x[by:]
    return out


def _agree_until(words: np.ndarray, at: int, period: int) -> int:
    """The first place from `at` on where a word differs from that `period` places on."""
    end, step = len(words) - period, 64
    while at < end:
        stop = min(at + step, end)
        unlike = words[at:stop] != words[at + period : stop + period]
        if unlike.any():
            return at + int(unlike.argmax())
        at, step = stop, step * 2
    return end


def _agree_since(words: np.ndarray, at: int, period: int) -> int:
    """The first place from which on words agree with those `period` places on, up to before `at`."""
    step = 64
    while at > 0:
        low = max(0, at - step)
        unlike = words[low:at] != words[low + period : at + period]
        if unlike.any():
            return at - int(unlike[::-1].argmax())
        at, step = low, step * 2
    return 0


def _primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether `period` is the smallest one: the first `period` words are no repetition themselves."""
    rest, prime = period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            small = period // prime
            if (words[start : start + period - small] == words[start + small : start + period]).all():
                return False
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return True


def _proposals(ids: np.ndarray, contexts: np.ndarray, periodic: np.ndarray, valid: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the synchronising set, and distances below 2 * scale to the next place with an equal context."""
    keys = np.where(periodic, _NONE, ids)
    least = _sliding_least(keys, scale + 1)
    chosen = np.flatnonzero(valid & (least != _NONE) & ((keys == least) | (_shifted(keys, scale) == least)))
    context = contexts[chosen]
    order = np.argsort(context, kind="stable")
    chosen, context = chosen[order], context[order]
    near = np.diff(chosen)
    which = np.flatnonzero((context[1:] == context[:-1]) & (near >= scale) & (near < 2 * scale))
    return chosen[which], near[which]


def find_runs(words: np.ndarray, sizes: np.ndarray) -> list[Run]:
    """Runs as (start, length, period) in several texts of numbered words, one after the other.

    `sizes` is the number of words of each text, which ends with a word that occurs nowhere else (and is
    not counted). A distance across texts is never taken for a period, since no stretch of agreeing words spans that word.
    """
    found: list[Run] = []
    for period in range(1, min(SMALL, len(words))):
        begin, end = _stretches(words[:-period] == words[period:])
        long = end - begin >= (EXPONENT - 1) * period
        found += [(b, e - b + period, period) for b, e in zip(begin[long].tolist(), end[long].tolist(), strict=True)]
    # Places of the texts that are still long enough, the hashes of `scale` words from there, and each text's end.
    ends = np.repeat(np.cumsum(sizes + 1) - 1, sizes + 1)
    size_of = np.repeat(sizes, sizes + 1)
    place = np.arange(len(words))
    ids, scale = mix(words.view(np.uint64)), 1
    while True:
        if scale >= SMALL:
            long = size_of >= EXPONENT * scale
            if not long.all():
                place, ids, ends, size_of = (x[long] for x in (place, ids, ends, size_of))
            if not len(place):
                break
        contexts = mix(ids * np.uint64(0x9E3779B97F4A7C15) + _shifted(ids, scale))
        if scale >= SMALL:
            inside = np.zeros(len(words) + 1, np.int32)
            for start, length, period in found:
                if period * EXPONENT <= scale <= length:
                    inside[start] += 1
                    inside[start + length - scale + 1] -= 1
            periodic = (np.cumsum(inside)[:-1] > 0)[place]
            at, distance = _proposals(ids, contexts, periodic, place + 2 * scale <= ends, scale)
            order = np.lexsort((at, distance))
            done, last = -1, 0
            for i, period in zip(place[at[order]].tolist(), distance[order].tolist(), strict=True):
                if period == last and i < done:
                    continue
                done, last = _agree_until(words, i, period), period
                if done > i:
                    start = _agree_since(words, i, period)
                    if done - start >= (EXPONENT - 1) * period:
                        found.append((start, done - start + period, period))
        ids, scale = contexts, 2 * scale
    return [(s, n, q) for s, n, q in found if n >= WORDS and _primitive(words, s, q)]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    word = pc.not_equal(flat, "")
    upto = np.concatenate([[0], np.cumsum(word.to_numpy(zero_copy_only=False))])
    return flat.filter(word), np.diff(upto[offsets])


def _described(texts: pa.Array) -> pa.StructArray:
    flat, sizes = _words(texts)
    coded = flat.dictionary_encode()
    upto = np.concatenate([[0], np.cumsum(sizes)])
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    words = np.empty(len(flat) + len(sizes), np.int64)
    words[np.arange(len(flat)) + text_of] = coded.indices.to_numpy()
    words[upto[1:] + np.arange(len(sizes))] = -1 - np.arange(len(sizes))
    runs: list[list[dict]] = [[] for _ in sizes]
    drop = np.zeros(len(flat) + 1, np.int32)
    begins = upto[:-1] + np.arange(len(sizes))
    found = find_runs(words, sizes)
    texts_of = np.searchsorted(begins, [s for s, _, _ in found], "right") - 1
    for (start, length, period), text in sorted(zip(found, texts_of.tolist(), strict=True), key=lambda x: (x[0][0], x[0][2])):
        runs[text].append({"start": start - int(begins[text]), "length": length, "period": period})
        drop[start - text + period] += 1
        drop[start - text + length] -= 1
    keep = np.cumsum(drop)[:-1] == 0
    kept = np.concatenate([[0], np.cumsum(keep)])[upto]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat.filter(pa.array(keep))), " ")
    return pa.StructArray.from_arrays([pa.array(runs, _RUNS), collapsed], ["runs", "collapsed"])


def _of_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        # Texts in slices of about TOGETHER words at most; there are at most half as many words as bytes.
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) // 2)
        cuts = np.flatnonzero(np.diff(size // TOGETHER, prepend=0)).tolist()
        cuts = sorted({0, len(texts), *cuts, *(c + 1 for c in cuts)})
        parts = [_described(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:], strict=False)]
        yield pa.concat_arrays(parts) if parts else _described(texts)


def periodic_runs(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """`docs` with `runs` (in order of start, then period) and `collapsed`, the kept words joined by one space.

    A word is kept unless a run holds it behind its first period. `text` is an expression to search in
    place of the column. Columns of `docs` called like the new ones are not lost: the new ones get underscores before.
    """
    found, runs = fresh(docs, "found"), fresh(docs, "runs")
    collapsed = fresh(docs, "collapsed")
    search = F.arrow_udf(_of_texts, f"runs {RUNS}, collapsed string")
    described = docs.withColumn(found, search(F.col("text") if text is None else text))
    return described.select(*docs.columns, F.col(found)["runs"].alias(runs), F.col(found)["collapsed"].alias(collapsed))


def collapse(docs: DataFrame) -> DataFrame:
    """`docs` with the first period only of each run in `text`; texts without a run are left as they are."""
    whole = fresh(docs, "whole")
    found = periodic_runs(docs.select(F.struct(*docs.columns).alias(whole), "text"))
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == "text" else F.col(whole)[c].alias(c) for c in docs.columns])


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text, by a checksum of its id, ends in a loop of its own words.

    With n words, h the checksum and g = floor(h / 10), words from a = g % n on repeat with the period
    p = 1 + floor((n - a) / (3 + g % 8)). Rows without an id, or without words, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(0)))
    a = F.col("g") % F.col("n")
    rest = F.col("n") - a
    p = 1 + F.floor(rest / (3 + F.col("g") % 8))
    loop = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil(rest / p).cast("int")))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(loop, F.lit(1), rest)), " ")
    return (
        docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
        .withColumn("n", F.size("words"))
        .select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(looped(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (
        found.withColumn("best", longest)
        .select(
            "doc_id",
            F.size("runs").cast("bigint").alias("n_runs"),
            F.col("best.s").alias("start"),
            (-F.col("best.l")).alias("length"),
            F.col("best.p").alias("period"),
            F.floor(-1000 * F.col("best.l") / F.col("best.p")).cast("bigint").alias("exponent_milli"),
            F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
SQL: dict[str, str] = {}
