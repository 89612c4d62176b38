"""Token ids on disk, compressed by Re-Pair grammars.

Documents are put in ascending order of id by a range shuffle, encoded, closed by an end id each, and
cut into shards of about SHARD_TOKENS ids. In each shard frequent pairs of neighbouring symbols are
replaced by new symbols, again and again, until no pair has USES places; a pair never crosses the end of a
document. A shard is one row of a Parquet folder: its rules, the number of ids that each rule
expands to, the symbols, and for each document how many symbols and ids it has. With the
expansion lengths any range of ids is found and decoded without its neighbours.

Words repeat, and the tokenizer never joins ids across blanks, nor across the runs of letters and of
marks in a plain word: a task encodes each distinct run once with the library and composes words, and texts,
from these. A Python worker keeps what it has learned for its next task, up to LEXICON words and a slice's; its memory is
bounded by these, a batch of texts, and a shard.

Defined cases: null and empty texts are just the end id; a null doc_id comes last; rows with equal
ids are ordered by a hash of their text. An empty table gives no shards and an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals.llm.common import shared_folder, table

END = 1
SHARD_TOKENS = 1 << 20
# Text of a partition, from small tables to large ones; partitions wanted before they get larger than the first.
PARTITION_BYTES, LARGE_BYTES, PARTITIONS = 24 << 20, 512 << 20, 20_000
LEXICON = 1_200_000
# Text encoded at a time.
SLICE_BYTES = 8 << 20
# Parts encoded in a call; how the vocabulary marks the last id of a part.
TOGETHER, WORD_END = 2_000, "</w>"
# Words of these characters only (no apostrophe or special token, lower case letter by letter) are cut by the
# tokenizer into runs of letters, single digits, and runs of the rest, whatever stands beside them.
_PLAIN = r"^[!-&(-;=-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+$"
_PART = r"([a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+)"
# Put between parts; no plain word has it.
CUT = "\x01"
# Grammar: least uses of a rule; bins in which pairs are counted, as a power of 2.
USES, BIN_BITS = 8, 19

SHARDS = (
    "part int, shard int, n_tokens bigint, vocabulary int, rule_left array<int>, rule_right array<int>, "
    "rule_length array<int>, width int, symbols binary, doc_ids array<bigint>, doc_symbols array<int>, doc_tokens array<int>"
)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Lexicon:
    """Numbers of strings, in the order in which they are first met."""

    def __init__(self) -> None:
        self.known = pa.array([], pa.string())

    def __len__(self) -> int:
        return len(self.known)

    def meet(self, strings: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The numbers of strings, and the new ones among them; each distinct one is looked up once."""
        coded = strings.dictionary_encode()
        distinct = coded.dictionary
        found = pc.index_in(distinct, value_set=self.known)
        numbers = found.fill_null(-1).to_numpy().astype(np.int64)
        new = distinct.filter(found.is_null())
        numbers[numbers < 0] = np.arange(len(self), len(self) + len(new))
        self.known = pa.concat_arrays([self.known, new])
        return numbers[coded.indices.to_numpy()], new


class Runs:
    """Ids of numbered strings, one after the other, in arrays with room to grow."""

    def __init__(self) -> None:
        self._flat, self._begins, self.n = np.zeros(1024, np.int32), np.zeros(1024, np.int64), 0

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        at, n = int(self._begins[self.n]), len(sizes)
        self._flat = _with_room(self._flat, at + len(flat))
        self._begins = _with_room(self._begins, self.n + n + 1)
        self._flat[at : at + len(flat)] = flat
        self._begins[self.n + 1 : self.n + n + 1] = at + np.cumsum(sizes)
        self.n += n

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings numbered so, in a row, and how many each has."""
        begins = self._begins[which]
        sizes = self._begins[which + 1] - begins
        upto = np.cumsum(sizes)
        # The place in the flat array is the place in the row, shifted for each string.
        return self._flat[np.arange(sizes.sum()) + np.repeat(begins - upto + sizes, sizes)], sizes


def _with_room(x: np.ndarray, n: int) -> np.ndarray:
    if n <= len(x):
        return x
    out = np.zeros(max(n, 2 * len(x)), x.dtype)
    out[: len(x)] = x
    return out


class Encoder:
    """Encodes UTF-8 texts; each distinct word, and each part of plain words, goes to the library once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self._clear()

    def _clear(self) -> None:
        self.words, self.parts = Lexicon(), Lexicon()
        self.of_words, self.of_parts = Runs(), Runs()

    def _encode_parts(self, parts: list[str]) -> None:
        """Encode new parts in one text; the last id of each has the mark of an end."""
        for at in range(0, len(parts), TOGETHER):
            some = parts[at : at + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != len(some):
                raise ValueError("the tokenizer does not cut words as expected")
            self.of_parts.add(ids, np.diff(ends, prepend=-1))

    def _learn(self, new: pa.Array) -> None:
        """Encode new words, those of plain letters and marks by their parts."""
        plain = pc.match_substring_regex(new, _PLAIN)
        other = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in new.filter(pc.invert(plain)).to_pylist()]
        cut = pc.replace_substring_regex(pc.utf8_lower(new.filter(plain)), _PART, r"\1" + CUT)
        cut = pc.split_pattern(pc.utf8_rtrim(cut, CUT), CUT)
        which, parts = self.parts.meet(cut.flatten())
        self._encode_parts(parts.to_pylist())
        ids, sizes = self.of_parts.take(which)
        upto = np.concatenate([[0], np.cumsum(sizes)])[cut.offsets.to_numpy()]
        # Words of either kind, back in their order.
        pieces = Runs()
        pieces.add(ids, np.diff(upto))
        pieces.add(np.array([i for x in other for i in x], np.int64), np.array([len(x) for x in other], np.int64))
        plain = plain.to_numpy(zero_copy_only=False)
        order = np.empty(len(new), np.int64)
        order[plain] = np.arange(plain.sum())
        order[~plain] = plain.sum() + np.arange(len(other))
        self.of_words.add(*pieces.take(order))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all UTF-8 texts in a row, END after each, and how many each has with it."""
        if len(self.words) > LEXICON:
            self._clear()
        # Blanks at either end leave an empty word, which has no ids.
        split = pc.ascii_split_whitespace(pc.fill_null(texts, b"").view(pa.string()))
        which, new = self.words.meet(split.flatten())
        if len(new):
            self._learn(new)
        ids, sizes = self.of_words.take(which)
        upto = np.concatenate([[0], np.cumsum(sizes)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        sizes = np.diff(upto) + 1
        out = np.full(len(ids) + len(sizes), END, np.int32)
        text = np.ones(len(out), bool)
        text[np.cumsum(sizes) - 1] = False
        out[text] = ids
        return out, sizes


@lru_cache(1)
def kept_encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker, with the words it has learned."""
    return Encoder(path)


def _alternate(at: np.ndarray) -> np.ndarray:
    """Of places, every second one of each run of successive ones, from its first."""
    place = np.arange(len(at))
    begins = np.concatenate([[True], np.diff(at) != 1])[: len(at)]
    return (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0


def _by_pair(code: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order, and their places in ascending order for each."""
    bits = int(at[-1]).bit_length() if len(at) else 1
    if len(at) and int(code.max()) < 1 << (64 - bits):
        both = np.sort((code << np.uint64(bits)) | at.astype(np.uint64))
        return both >> np.uint64(bits), (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    order = np.argsort(code, kind="stable")
    return code[order], at[order]


def _frequent(symbols: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of pairs, in order of the pairs; where each pair begins, and its uses, which are at most its places.

    Pairs are counted in bins first, and only those one by one whose bin has USES places. A place that is ruled out
    is no longer `alive`: its pair can only get rarer until one of its symbols is replaced.
    """
    at = np.flatnonzero(alive)
    left, right = symbols.take(at).view(np.uint32), symbols[1:].take(at).view(np.uint32)
    bins = (left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)) >> np.uint32(32 - BIN_BITS)
    often = (np.bincount(bins, minlength=1 << BIN_BITS) >= USES)[bins]
    alive[at[~often]] = False
    bits = np.uint64(int(symbols.max()).bit_length())
    code, at = _by_pair((left[often].astype(np.uint64) << bits) | right[often], at[often])
    begins = np.concatenate([[True], code[1:] != code[:-1]])[: len(at)]
    # A symbol followed by itself is used every other time.
    twice = np.flatnonzero(code >> bits == code & ((np.uint64(1) << bits) - np.uint64(1)))
    if len(twice):
        used = np.ones(len(at), bool)
        used[twice] = _alternate(at[twice])
        at, begins = at[used], begins[used]
    begins = np.flatnonzero(begins)
    return at, begins, np.diff(begins, append=len(at))


def compress(ids: np.ndarray, last: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, the rules as an array of pairs, and for each symbol if it ends a document.

    `last` marks the last id of each document. Symbol vocabulary + k stands for rule k's pair. A round
    replaces, of the pairs with USES places, from the most frequent on, all that cannot overlap with one taken before: no
    symbol is the left one of one pair and the right one of another. So each rule gets all places of its
    pair, and rounds go on until no pair has USES places.
    """
    symbols, alive, ends = ids.astype(np.int32), ~last, np.flatnonzero(last)
    rules: list[tuple[int, int]] = []
    while len(symbols) > 1:
        alive[-1] = False
        places, begins, uses = _frequent(symbols, alive)
        often = np.flatnonzero(uses >= USES)
        often = often[np.argsort(-uses[often], kind="stable")]
        first = places[begins[often]]
        rule_of = np.full(len(begins), -1, np.int32)
        lefts, rights = set(), set()
        before = len(rules)
        for i, a, b in zip(often.tolist(), symbols[first].tolist(), symbols[first + 1].tolist(), strict=True):
            if not (a in rights or b in lefts or a == b and a in lefts):
                lefts.add(a)
                rights.add(b)
                rule_of[i] = vocabulary + len(rules)
                rules.append((a, b))
        if len(rules) == before:
            break
        taken = np.flatnonzero(rule_of >= 0)
        sizes = uses[taken]
        at = places[np.arange(sizes.sum()) + np.repeat(begins[taken] + sizes - np.cumsum(sizes), sizes)]
        symbols[at] = np.repeat(rule_of[taken], sizes)
        alive[at] = True
        alive[at[at > 0] - 1] = True
        gone = np.zeros(len(symbols), bool)
        gone[at + 1] = True
        # Where a document's last symbol has gone into a rule, the rule's symbol is the last one.
        ends -= gone[ends]
        alive[ends] = False
        stays = np.flatnonzero(~gone)
        ends = np.searchsorted(stays, ends)
        symbols, alive = symbols[stays], alive[stays]
    last = np.zeros(len(symbols), bool)
    last[ends] = True
    return symbols, np.array(rules, np.int64).reshape(-1, 2), last


def rule_lengths(rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """How many ids each rule expands to."""
    out = np.ones(vocabulary + len(rules), np.int64)
    for k, (a, b) in enumerate(rules):
        out[vocabulary + k] = out[a] + out[b]
    return out[vocabulary:]


def _shard(part: int, shard: int, doc_ids: pa.Array, ids: np.ndarray, tokens: np.ndarray, vocabulary: int) -> dict:
    last = np.zeros(len(ids), bool)
    last[np.cumsum(tokens) - 1] = True
    symbols, rules, last = compress(ids, last, vocabulary)
    width = 2 if vocabulary + len(rules) <= 1 << 16 else 4
    return {
        "part": part,
        "shard": shard,
        "n_tokens": len(ids),
        "vocabulary": vocabulary,
        "rule_left": rules[:, 0],
        "rule_right": rules[:, 1],
        "rule_length": rule_lengths(rules, vocabulary),
        "width": width,
        "symbols": symbols.astype(f"<u{width}").tobytes(),
        "doc_ids": doc_ids,
        "doc_symbols": np.diff(np.flatnonzero(last), prepend=-1),
        "doc_tokens": tokens,
    }


_ROW = pa.schema(
    [(c, pa.int32()) for c in ("part", "shard")]
    + [("n_tokens", pa.int64()), ("vocabulary", pa.int32())]
    + [(c, pa.list_(pa.int32())) for c in ("rule_left", "rule_right", "rule_length")]
    + [("width", pa.int32()), ("symbols", pa.binary()), ("doc_ids", pa.list_(pa.int64()))]
    + [(c, pa.list_(pa.int32())) for c in ("doc_symbols", "doc_tokens")]
)


def _row(shard: dict) -> pa.RecordBatch:
    def column(value: object, of: pa.DataType) -> pa.Array:
        if pa.types.is_list(of):
            return pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), pa.array(value, of.value_type))
        return pa.array([value], of)

    return pa.RecordBatch.from_arrays([column(shard[f.name], f.type) for f in _ROW], schema=_ROW)


def write_shards(docs: DataFrame, path: str, tokenizer_path: str) -> None:
    """Encode all documents and write the shards, in order of (part, shard), to a new Parquet folder."""
    bytes_in = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = min(LARGE_BYTES, max(PARTITION_BYTES, bytes_in // PARTITIONS))
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(max(1, -(-bytes_in // size)), *order).sortWithinPartitions(*order)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        encoder = kept_encoder(tokenizer_path)
        vocabulary = encoder.tokenizer.get_vocab_size(with_added_tokens=True)
        doc_ids, ids, tokens = pa.array([], pa.int64()), np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = [0, *(np.flatnonzero(np.diff(upto // SLICE_BYTES)) + 1).tolist(), len(batch)]
            for at, stop in zip(cuts, cuts[1:], strict=False):
                some = batch.slice(at, stop - at)
                more_ids, more_tokens = encoder.encode(some.column("text"))
                doc_ids = pa.concat_arrays([doc_ids, some.column("doc_id")])
                ids, tokens = np.concatenate([ids, more_ids]), np.concatenate([tokens, more_tokens])
                while len(ids) >= SHARD_TOKENS:
                    docs = int(np.searchsorted(np.cumsum(tokens), SHARD_TOKENS)) + 1
                    size = int(tokens[:docs].sum())
                    yield _row(_shard(part, n, doc_ids[:docs], ids[:size], tokens[:docs], vocabulary))
                    doc_ids, ids, tokens, n = doc_ids[docs:], ids[size:], tokens[docs:], n + 1
        if len(ids):
            yield _row(_shard(part, n, doc_ids, ids, tokens, vocabulary))

    ordered.mapInArrow(shards, SHARDS).write.parquet(path)


def expand(shard: pd.Series, first: int, stop: int) -> np.ndarray:
    """The ids numbered first to stop - 1 of a shard; symbols outside that range are not expanded."""
    n, rules = shard["vocabulary"], np.column_stack([shard["rule_left"], shard["rule_right"]]).astype(np.int64)
    length = np.concatenate([np.ones(n, np.int64), np.asarray(shard["rule_length"], np.int64)])
    symbols = np.frombuffer(shard["symbols"], f"<u{shard['width']}").astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(length[symbols])])
    a = np.searchsorted(upto, first, "right") - 1
    b = np.searchsorted(upto, stop, "left")
    symbols = symbols[a:b]
    # What each symbol expands to, one after the other; a rule's parts stand before it.
    starts = np.concatenate([[0], np.cumsum(length)])
    flat = np.empty(starts[-1], np.int64)
    flat[:n] = np.arange(n)
    for at, half, end, x, y in zip(
        starts[n:-1].tolist(), (starts[n:-1] + length[rules[:, 0]]).tolist(), starts[n + 1 :].tolist(), starts[rules[:, 0]].tolist(), starts[rules[:, 1]].tolist(), strict=True
    ):
        flat[at:half] = flat[x : x + half - at]
        flat[half:end] = flat[y : y + end - half]
    size = length[symbols]
    out = np.repeat(starts[symbols] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(symbols) else symbols
    ids = flat[out + np.arange(len(out))]
    return ids[first - upto[a] : stop - upto[a]].astype(np.uint32)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a folder of shards: doc_id, start, n_tokens, ids_crc32, decoded from the symbols.

    Numbers of ids are summed first over parts, then over the shards of a part.
    """
    shards = spark.read.parquet(path)
    sizes = shards.select("part", "shard", "n_tokens")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("part_start"))
    )
    starts = sizes.join(parts, "part").select(
        "part",
        "shard",
        (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(before.partitionBy("part").orderBy("shard")), F.lit(0))).alias("shard_start"),
    )

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, shard in batch.iterrows():
                ids = expand(shard, 0, shard["n_tokens"]).astype("<u4")
                tokens = np.asarray(shard["doc_tokens"], np.int64)
                ends = np.cumsum(tokens)
                yield pd.DataFrame(
                    {
                        "part": shard["part"],
                        "shard": shard["shard"],
                        "doc_id": pd.array(list(shard["doc_ids"]), "Int64"),
                        "start": ends - tokens,
                        "n_tokens": tokens,
                        "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends - tokens, ends, strict=True)],
                    }
                )

    found = shards.mapInPandas(decode, "part int, shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenize(docs: DataFrame, tokenizer_path: str | None = None, path: str | None = None) -> DataFrame:
    """Write shards to `path` (a new folder in the shared one if none is given) and read them back."""
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/shards"
    write_shards(docs, path, tokenizer_path or tokenizer_file())
    return read_shards(spark, path)


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(table(spark, sf_dir, "documents"))


QUERIES = {"op10_tokens": op10_tokens}
SQL: dict[str, str] = {}
