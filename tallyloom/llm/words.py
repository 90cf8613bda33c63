"""Words of whole texts as 64-bit hashes, a batch of texts at a time.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z in lower
case.  A word's hash is multilinear over its bytes (one odd random factor per
place), so two different words agree with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEED = np.random.default_rng(20260)
_BYTE = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACE = _SEED.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)

CHUNK_BYTES = 1 << 20


def _places(n: int) -> np.ndarray:
    """Factors for the first ``n`` places of a word."""
    global _PLACE
    if len(_PLACE) < n:
        more = np.random.default_rng(7).integers(1, 1 << 63, 2 * n, dtype=np.uint64) | np.uint64(1)
        more[: len(_PLACE)] = _PLACE
        _PLACE = more
    return _PLACE


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of ``h`` over all bits (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each text begins (one more entry: the end).  Nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def hash_words(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, how many words each text ``data[cuts[i]:cuts[i+1]]`` has, where words begin and end."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = cuts[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, cuts))
    if not len(starts):
        return np.zeros(0, np.uint64), counts, starts, ends
    lengths = ends - starts
    with np.errstate(over="ignore"):
        flat = data[inside]
        begin = np.cumsum(lengths) - lengths
        place = np.arange(len(flat)) - np.repeat(begin, lengths)
        parts = _BYTE[flat] * _places(int(lengths.max()))[place]
        h = np.add.reduceat(parts, begin) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(h), counts, starts, ends


def located_words(data: np.ndarray, cuts: np.ndarray) -> Iterator[tuple]:
    """For runs of whole texts of about CHUNK_BYTES: first text, text after the last, and what ``hash_words`` finds."""
    at = 0
    while at < len(cuts) - 1:
        to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + CHUNK_BYTES, "right")) - 1)
        hashes, counts, starts, ends = hash_words(data[cuts[at]: cuts[to]], cuts[at: to + 1] - cuts[at])
        yield at, to, hashes, counts, starts + cuts[at], ends + cuts[at]
        at = to


def words_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of first text, hashes of words, words per text) for runs of whole texts of about CHUNK_BYTES."""
    for at, _, hashes, counts, _, _ in located_words(*raw_bytes(texts)):
        yield at, hashes, counts


def split_texts(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashed words of each text in turn."""
    for _, hashes, counts in words_of(texts):
        yield from np.split(hashes, np.cumsum(counts)[:-1])


_FACTORS = np.random.default_rng(99).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of ``size`` words in ascending order; a shorter text is one shingle, no words are none."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, size)
    with np.errstate(over="ignore"):
        sums = sum(words[i: n - k + 1 + i] * _FACTORS[i] for i in range(k)) + np.uint64(k)
    return np.unique(mix(sums))


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is made of one at a time stays small."""
    for b in batches:
        for begin in range(0, b.num_rows, rows):
            yield b.slice(begin, rows)
