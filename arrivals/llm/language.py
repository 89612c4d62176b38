"""Language identification by nearest centroid.

A text is a vector of letter trigrams (hashed bytes of the lower-cased words, blanks between them)
weighted by TF-IDF and of length 1. Each language has several centroids, found by spherical
k-means among its labelled texts; a text gets the language of the centroid with the
largest cosine, and is rejected if even that is below a limit, learned for each centroid and length of text:
LENIENCE times the cosine that all but QUANTILE of the sample's texts of that length reach, where texts of each length are
pieces of the sample's. So a text is rejected that is much farther from all centroids than any text
learned from, and short texts, which are far from all, are measured by short ones.

Document frequencies are counted over all labelled training texts. The centroids are fitted on a bounded
sample: of each language about SAMPLE texts, chosen by a hash of the id, and about SAMPLE_ALL in all.
The model is BINS weights for each centroid, whatever the size of the table.

Defined cases: null texts and texts without a letter are `und`, score 0, and rejected. A null id is
neither held out nor learned from. Without labelled texts everything is `und`. Ties go to the first
language by code point. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm.common import fresh, table

BINS = 1 << 13
CENTROIDS = 3
SAMPLE, SAMPLE_ALL = 400, 20_000
ITERATIONS = 10
# Limits of rejection: a low quantile of the sample's cosines, and the share of it that suffices. Words of the pieces
# that stand for short texts, and where a class of lengths, in trigrams, ends.
QUANTILE, LENIENCE = 0.01, 0.6
PIECES = (4, 8, 16, 32, 64)
LENGTHS = (12, 24, 48, 96, 192, 384)
FOLDS, HELD_OUT = 5, 0
BATCH = 256
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_FOLD = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def trigrams(text: str | None) -> np.ndarray:
    """Bins of the trigrams of a text, one for each occurrence; none if it has no letter."""
    if not text or not _LETTER.search(text):
        return np.zeros(0, np.int64)
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    line = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split()) + b" "
    b = np.frombuffer(line, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64)


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    """Rows of length 1, or 0 for texts without trigrams."""
    out = np.zeros((len(texts), BINS), np.float32)
    for row, text in zip(out, texts, strict=True):
        found = np.bincount(trigrams(text), minlength=BINS)
        at = np.flatnonzero(found)
        row[at] = (1 + np.log(found[at])) * idf[at]
    norm = np.sqrt(np.einsum("ij,ij->i", out, out))
    return out / np.where(norm > 0, norm, 1)[:, None]


def centroids(rows: np.ndarray, k: int = CENTROIDS, iterations: int = ITERATIONS) -> np.ndarray:
    """Spherical k-means; the start takes the row least like those taken before."""
    start = [0]
    near = rows @ rows[0]
    while len(start) < min(k, len(rows)):
        start.append(int(np.argmin(near)))
        near = np.maximum(near, rows @ rows[start[-1]])
    centres = rows[start]
    for _ in range(iterations):
        of = np.argmax(rows @ centres.T, axis=1)
        sums = np.stack([rows[of == i].sum(axis=0) if (of == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-12)[:, None]
    return centres


def pieces(text: str, seed: int) -> list[str]:
    """A piece of each length of PIECES from anywhere in a text, as far as it has more words than that."""
    words = text.split()
    starts = np.random.default_rng(seed).random(len(PIECES))
    return [" ".join(words[(at := int(share * (len(words) - n))) : at + n]) for n, share in zip(PIECES, starts, strict=True) if len(words) > n]


def limits(of: np.ndarray, cosine: np.ndarray, sizes: np.ndarray, centres: int) -> np.ndarray:
    """The least cosine to accept, for each centroid and class of lengths.

    `of` is the centroid of each sample, `sizes` its number of trigrams. A class without samples has the limit of the next
    shorter one that has some, and 0 if there is none: nothing is then known against a text.
    """
    out = np.zeros((centres, len(LENGTHS) + 1), np.float32)
    classes = np.searchsorted(LENGTHS, sizes, "right")
    for c in range(centres):
        for length in range(len(LENGTHS) + 1):
            own = cosine[(of == c) & (classes == length)]
            if len(own):
                out[c, length] = LENIENCE * np.quantile(own, QUANTILE)
            elif length:
                out[c, length] = out[c, length - 1]
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centres: np.ndarray
    idf: np.ndarray
    limits: np.ndarray  # of each centroid and class of lengths

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores, _ = self.judge(texts)
        return names, scores

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, cosines, and whether the texts are rejected."""
        names, scores, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for at in range(0, len(texts), BATCH):
            some = texts[at : at + BATCH]
            if not self.languages:
                names += [UNKNOWN] * len(some)
                continue
            cosine = np.clip(vectors(some, self.idf) @ self.centres.T, 0, 1)
            best = np.argmax(cosine, axis=1)
            # Bytes stand for trigrams: there is one for each, but for blanks in a row.
            sizes = np.array([len(t.encode("utf-8", "replace")) if t else 0 for t in some])
            limit = self.limits[best, np.searchsorted(LENGTHS, sizes, "right")]
            spoken = [bool(t and _LETTER.search(t)) for t in some]
            names += [self.languages[i] if s else UNKNOWN for i, s in zip(best, spoken, strict=True)]
            scores[at : at + len(some)] = np.where(spoken, cosine[np.arange(len(some)), best], 0)
            rejected[at : at + len(some)] = (scores[at : at + len(some)] < limit) | ~np.array(spoken, bool)
        return names, scores, rejected


def train(docs: DataFrame) -> Model:
    """Fit the model on the labelled texts outside the held-out fold."""
    labelled = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, BINS), np.float32), np.ones(BINS, np.float32), np.zeros((0, len(LENGTHS) + 1), np.float32))

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount(trigrams(text), minlength=BINS) > 0
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bin": at, "n": total[at]})

    counted = labelled.select("text").mapInPandas(frequencies, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
    idf = np.zeros(BINS)
    for r in counted.collect():  # at most BINS rows
        idf[r["bin"]] = r["n"]
    idf = np.log((1 + sum(sizes.values())) / (1 + idf)) + 0.05

    each = min(SAMPLE, SAMPLE_ALL // len(sizes))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(each / n))])
    drawn = labelled.filter(draw < share[F.col("lang")]).select("lang", "doc_id", "text")

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for lang, doc_id, text in zip(batch["lang"], batch["doc_id"], batch["text"], strict=True):
                for n, t in enumerate([text, *(pieces(text, int(doc_id) & (1 << 62) - 1) if text else [])]):
                    size = len(t.encode("utf-8", "replace")) if t else 0
                    rows.append((lang, n > 0, size, *np.unique(trigrams(t), return_counts=True)))
            yield pd.DataFrame(rows, columns=["lang", "piece", "size", "bins", "counts"])

    # About SAMPLE_ALL texts and their pieces, as trigrams.
    rows = drawn.mapInPandas(bins, "lang string, piece boolean, size int, bins array<int>, counts array<int>").toPandas()

    def weighted(own: pd.DataFrame) -> np.ndarray:
        matrix = np.zeros((len(own), BINS), np.float32)
        for row, at, n in zip(matrix, own["bins"], own["counts"], strict=True):
            row[np.asarray(at, np.int64)] = (1 + np.log(np.asarray(n))) * idf[np.asarray(at, np.int64)]
        norm = np.linalg.norm(matrix, axis=1)
        return matrix / np.where(norm > 0, norm, 1)[:, None]

    languages: list[str] = []
    centres: list[np.ndarray] = []
    bounds: list[np.ndarray] = []
    for lang, own in sorted(rows.groupby("lang")):
        # Whatever order they came in.
        own = own.assign(order=[(tuple(a), tuple(b)) for a, b in zip(own["bins"], own["counts"], strict=True)])
        own = own[own["bins"].map(len) > 0].sort_values(["piece", "order"])
        whole = weighted(own[~own["piece"]])
        if len(whole):
            centres.append(centroids(whole))
            languages += [lang] * len(centres[-1])
            of, cosine = [], []
            for at in range(0, len(own), BATCH):
                near = weighted(own.iloc[at : at + BATCH]) @ centres[-1].T
                of.append(near.argmax(axis=1))
                cosine.append(near.max(axis=1))
            bounds.append(limits(np.concatenate(of), np.concatenate(cosine), own["size"].to_numpy(), len(centres[-1])))
    if not centres:
        return Model([], np.zeros((0, BINS), np.float32), np.ones(BINS, np.float32), np.zeros((0, len(LENGTHS) + 1), np.float32))
    return Model(languages, np.concatenate(centres).astype(np.float32), idf.astype(np.float32), np.concatenate(bounds))


def predict(docs: DataFrame, model: Model, out: str = "language") -> DataFrame:
    """`docs` with a column `out` (with underscores before if there is one) of (lang_pred, score, rejected)."""
    out = fresh(docs, out)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        names, scores, rejected = shared.value.judge([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores, "rejected": rejected})

    return docs.withColumn(out, nearest("text"))


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    out = fresh(docs, "language")
    return predict(docs, train(docs), out).filter(~F.col(f"{out}.rejected")).drop(out)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "language.*")


QUERIES = {"op5_language": op5_language}
SQL: dict[str, str] = {}
