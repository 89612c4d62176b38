"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives a fixed set of numbers, binned by quantiles. Boosting goes round the features: a
shallow tree (up to four leaves) on one feature at a time is fitted to what the model still
gets wrong, and added, shrunk, to that feature's lookup table. Then the pairs of features that
explain most of the rest get a table each, by trees with one cut on either axis. A document is scored
by adding up its table entries: a few vectorised look-ups for each.

The texts are read once: their numbers, a few bytes for each document, are stored and joined with the
labels. The model is fitted on at most about SAMPLE labelled rows, chosen by a hash of the id, outside the
held-out fold.

Defined cases: null text counts as empty, and empty texts get a score like any other. A null id is
neither held out nor learned from. If the training labels are absent or all alike, every score is
their (smoothed) mean. Of several labels for one id the mean counts. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm.common import store, table

SAMPLE = 40_000
FOLDS, HELD_OUT = 3, 1
BINS, COARSE = 64, 12
ROUNDS, PAIRS, PAIR_ROUNDS, RATE = 150, 8, 60, 0.15
LEAST_LEAF = 20

FEATURES = (
    "size", "letters", "upper", "digits", "marks", "stops", "bars", "bangs", "beyond_ascii", "lines", "line_repeats",
    "word_length", "word_variety", "echoes", "marked_words", "upper_words", "bare_lines", "ratio",
)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def numbers(text: bytes | None) -> list[float]:
    """The values of FEATURES for a text in UTF-8."""
    b = text or b""
    of = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    size = max(1, len(b))
    words = b.split()
    n = max(1, len(words))
    lines = [x for x in b.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    upper, lower, digits = of[65:91].sum(), of[97:123].sum(), of[48:58].sum()
    stops, bars, bangs = of[[44, 46, 58, 59, 63]].sum(), of[124], of[33]
    blanks = of[9:14].sum() + of[32]
    beyond = of[128:].sum()
    marks = len(b) - upper - lower - digits - stops - bars - bangs - blanks - beyond
    echoes = sum(map(bytes.__eq__, words, words[1:]))
    marked = sum(map(bytes.endswith, words, [(b"*", b"#", b"$", b"%", b"&", b"!", b"|")] * len(words)))
    bare = sum(not x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines)
    variety = np.log(len(set(words)) + 1) / np.log(n + 1.5)
    return [
        np.log1p(len(b)), (lower + upper) / size, upper / size, digits / size, marks / size, stops / size, bars / size, bangs / size,
        beyond / size, np.log1p(len(lines)), 1 - len(set(lines)) / m, (len(b) - blanks) / n, variety, echoes / n, marked / n,
        sum(map(bytes.isupper, words)) / n, bare / m, len(zlib.compress(b, 1)) / (len(b) + 20),
    ]


def _tree(gain_at: np.ndarray, hess_at: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Leaf value for each bin of a greedy tree over ordered bins."""
    value = np.zeros(len(gain_at))
    parts = [(0, len(gain_at))]

    def best(a: int, b: int) -> tuple[float, int]:
        g, h = np.cumsum(gain_at[a:b]), np.cumsum(hess_at[a:b])
        if b - a < 2:
            return 0.0, a
        left = g[:-1] ** 2 / (h[:-1] + 1)
        right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1)
        fits = (h[:-1] > LEAST_LEAF / 10) & (h[-1] - h[:-1] > LEAST_LEAF / 10)
        gain = np.where(fits, left + right - g[-1] ** 2 / (h[-1] + 1), 0)
        at = int(np.argmax(gain))
        return float(gain[at]), a + at + 1

    while len(parts) < leaves:
        found = [(*best(a, b), a, b) for a, b in parts]
        gain, at, a, b = max(found, key=lambda x: x[0])
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, at), (at, b)]
    for a, b in parts:
        value[a:b] = gain_at[a:b].sum() / (hess_at[a:b].sum() + 1)
    return value


def _cross(gain_at: np.ndarray, hess_at: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best four quadrants of a grid."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gain_at, hess_at))
    k = gain_at.shape[0]
    cut = np.arange(1, k)

    def score(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return x**2 / (y + 1)

    def quadrants(x: np.ndarray) -> list[np.ndarray]:
        a = x[cut][:, cut]
        b, c = x[cut][:, [-1]] - a, x[[-1]][:, cut] - a
        return [a, b, c, x[-1, -1] - a - b - c]

    gs, hs = quadrants(g), quadrants(h)
    gain = sum(score(x, y) for x, y in zip(gs, hs, strict=True))
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    value = np.zeros((k, k))
    for rows, cols, x, y in zip(
        (slice(0, i + 1), slice(0, i + 1), slice(i + 1, k), slice(i + 1, k)),
        (slice(0, j + 1), slice(j + 1, k), slice(0, j + 1), slice(j + 1, k)),
        gs, hs, strict=True,
    ):
        value[rows, cols] = x[i, j] / (y[i, j] + 1)
    return float(gain[i, j]), value


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += values[np.searchsorted(edges, x[:, f], "right")]
        for a, b, values in self.pairs:
            total += values[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables of all features in turn, then those of the pairs."""
    mean = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(mean / (1 - mean))))
    if not len(y) or y.min() == y.max():
        return model
    n = x.shape[1]
    model.edges = [_edges(x[:, f], BINS) for f in range(n)]
    model.coarse = [_edges(x[:, f], COARSE) for f in range(n)]
    binned = [np.searchsorted(model.edges[f], x[:, f], "right") for f in range(n)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for f in range(n):
            p = 1 / (1 + np.exp(-total))
            k = len(model.tables[f])
            change = RATE * _tree(np.bincount(binned[f], y - p, k), np.bincount(binned[f], p * (1 - p), k))
            model.tables[f] += change
            total += change[binned[f]]
    grid = [np.searchsorted(model.coarse[f], x[:, f], "right") for f in range(n)]

    def cells(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        at = grid[a] * COARSE + grid[b]
        return tuple(np.bincount(at, w, COARSE * COARSE).reshape(COARSE, COARSE) for w in (y - p, p * (1 - p)))

    gains = [(_cross(*cells(a, b))[0], a, b) for a in range(n) for b in range(a + 1, n)]
    chosen = sorted(gains, key=lambda t: (-t[0], t[1:]))[:PAIRS]
    model.pairs = [(a, b, np.zeros((COARSE, COARSE))) for _, a, b in chosen]
    for _ in range(PAIR_ROUNDS):
        for a, b, values in model.pairs:
            change = RATE * _cross(*cells(a, b))[1]
            values += change
            total += change[grid[a], grid[b]]
    return model


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the array of numbers of each text."""

    @F.pandas_udf("array<float>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(numbers(t), np.float32) for t in texts])

    return docs.select("doc_id", of(F.col("text").cast("binary")).alias("x"))


def train(found: DataFrame, labels: DataFrame) -> Model:
    """Fit on about SAMPLE labelled rows of `features` outside the held-out fold."""
    marked = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("y"))
    )
    share = SAMPLE / max(1, marked.count())
    drawn = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    rows = found.join(drawn, "doc_id").select("doc_id", "x", "y").toPandas()
    x = np.array(rows["x"].tolist(), np.float32).reshape(len(rows), len(FEATURES))
    order = np.lexsort([*x.T, rows["doc_id"]])  # whatever order they came in
    return fit(x[order], rows["y"].to_numpy(float)[order])


def score(found: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of rows of `features`."""
    shared = found.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.array(x.tolist(), np.float32).reshape(len(x), len(FEATURES))))

    return found.select("doc_id", of("x").alias("score"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each document."""
    found = store(features(docs))
    return score(found, train(found, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_quality": op1_quality}
SQL: dict[str, str] = {}
