"""Hashes of words and of word sequences for whole batches of texts at once.

A word is hashed as a polynomial over random 64-bit values of its bytes, modulo 2**64, and mixed.
Prefix sums give all words of a batch in a few vectorised steps.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

PIECE = 1 << 19
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, 256, np.uint64)
_BASE = 0x5851F42D4C957F2B  # 3 modulo 8
_END = re.compile(rb"[ \t-\r]")


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(n, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a piece begin, and their hashes."""
    b = np.frombuffer(piece, np.uint8)
    change = np.diff(np.concatenate([[0], (~_BLANK[b]).view(np.int8), [0]]))
    begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    up, down = _powers(max(PIECE * 2, 1 << (len(b)).bit_length()))
    term = _BYTES[b] * up[: len(b)]
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
    return begin, mix((upto[end] - upto[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _pieces(text: bytes) -> list[bytes]:
    """A long text in pieces that end between words."""
    out = []
    while len(text) > PIECE and (m := _END.search(text, PIECE)):
        out.append(text[: m.start()])
        text = text[m.start() :]
    return [*out, text]


def words_hashed(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the hashes of its words, with A-Z in lower case."""
    lowered = [(t or b"").lower() for t in texts]
    out: list[np.ndarray] = []
    some: list[bytes] = []

    def flush() -> None:
        if some:
            begin, found = _hash(b"\n".join(some))
            starts = np.cumsum([len(t) + 1 for t in some])[:-1]
            out.extend(np.split(found, np.searchsorted(begin, starts)))
            some.clear()

    held = 0
    for text in lowered:
        if len(text) > PIECE:
            flush()
            held = 0
            out.append(np.concatenate([_hash(p)[1] for p in _pieces(text)]))
            continue
        if held + len(text) > PIECE:
            flush()
            held = 0
        some.append(text)
        held += len(text) + 1
    flush()
    return out


def sequences(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k successive words; of all words at once if there are fewer, but some."""
    n = min(k, len(words))
    if not n:
        return words
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i])
    return total
