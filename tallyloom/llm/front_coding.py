"""Anchored suffixes of texts, front-coded runs of them, and their merge.

A window is a string of ``WINDOW`` bytes.  Its anchor is the leftmost of its
grams of ``GRAM`` bytes with the least hash, so equal windows have their
anchors in the same place.  The windows of one anchor are consecutive and are
known by the suffix that begins at the anchor and the bytes before it, which is
why only anchors are sorted, not every position.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import zstandard

WINDOW = 200
GRAM = 64
SPREAD = WINDOW - GRAM + 1  # places that an anchor can have in a window
PIECE = 1 << 16  # window starts that are looked at together, few enough for a processor's cache
HEAD = 8  # bytes of the gram's hash that stand before each suffix

_PLACE = np.uint64((1 << 20) - 1)  # low bits that hold a place in a piece, which has PIECE + WINDOW bytes
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


class Anchors(NamedTuple):
    """One row for each anchor and stretch of consecutive windows that have it."""

    at: np.ndarray  # the anchor's byte
    first: np.ndarray  # first byte of the first window
    last: np.ndarray  # first byte of the last window
    gram: np.ndarray  # hash of the anchor's gram


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes that begin at each byte, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _ODD
    size = 1
    while size < GRAM:
        ahead = h[size:]
        h = h[: len(ahead)] * np.uint64(0xD6E8FEB86659FD93)
        h += ahead
        h ^= h >> _SHIFT
        h *= _ODD
        size *= 2
    return h


def _least(values: np.ndarray) -> np.ndarray:
    """The least of each SPREAD consecutive values."""
    size = 1
    while 2 * size <= SPREAD:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (SPREAD - size)], values[SPREAD - size:])


def anchors(data: np.ndarray, ends: np.ndarray) -> Anchors:
    """Anchors of all windows of the texts that lie one after the other in ``data`` and end at ``ends``."""
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(data) - WINDOW + 1, PIECE):
        part = data[begin: begin + PIECE + WINDOW - 1]
        grams = _grams(part)
        # ties go to the left: the place stands below the hash
        least = _least((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64))
        low, high = np.searchsorted(ends, (begin, begin + len(least) - 1), side="right")
        stops = np.minimum(ends[low: high + 1] - begin, len(least))
        room = np.maximum(ends[low: high + 1] - begin - WINDOW + 1, 0)  # windows end inside their text
        own = np.diff(stops, prepend=0)
        inside = np.arange(len(least)) < np.repeat(room, own)
        start = np.flatnonzero(inside) + begin
        place = (least[inside] & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.diff(place, prepend=-1))
        if len(new):
            stop = np.append(new[1:], len(place)) - 1
            found.append((place[new] + begin, start[new], start[stop], grams[place[new]]))
    if not found:
        return Anchors(*(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64)))
    return Anchors(*map(np.concatenate, zip(*found)))


class Run(NamedTuple):
    """Suffixes in order, each with its common prefix with the one before, and what belongs to each."""

    suffixes: list[bytes]  # the gram's hash, then the bytes from the anchor to the end of the last window
    common: list[int]
    before: list[bytes]  # the bytes from the begin of the first window to the anchor, backwards
    text: np.ndarray  # number of the text in its block
    at: np.ndarray  # byte of the anchor in its text


def common_prefixes(ordered: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each string with the one before it; 0 for the first."""
    if not ordered:
        return np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, ordered), np.int64, len(ordered))
    width = int(sizes.max()) + 1
    rows = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in ordered), np.uint8).reshape(-1, width)
    differs = rows[1:] != rows[:-1]
    differs[:, -1] = True
    shared = np.minimum(differs.argmax(1), np.minimum(sizes[1:], sizes[:-1]))
    return np.concatenate([[0], shared])


def sorted_run(data: np.ndarray, begins: np.ndarray, texts: np.ndarray, found: Anchors) -> Run:
    """The anchors' suffixes in order; ``texts`` are their texts, which begin at ``begins``."""
    raw = data.tobytes()
    heads = (found.gram * _ODD).astype(">u8").tobytes()  # anchors have small hashes; these are evenly spread
    suffixes = [heads[HEAD * i: HEAD * i + HEAD] + raw[a: e] for i, (a, e) in enumerate(
        zip(found.at.tolist(), (found.last + WINDOW).tolist()))]
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    ordered = [suffixes[i] for i in order]
    first, at = found.first.tolist(), found.at.tolist()
    before = [raw[first[i]: at[i]][::-1] for i in order]
    rows = np.array(order, np.int64)
    return Run(ordered, common_prefixes(ordered).tolist(), before, texts[rows], found.at[rows] - begins[texts[rows]])


def page(run: Run, begin: int, end: int) -> bytes:
    """Front-coded bytes of a stretch of a run; its first suffix is whole."""
    common = np.array(run.common[begin:end], np.uint8)
    common[:1] = 0
    tails = [s[c:] for s, c in zip(run.suffixes[begin:end], common.tolist())]
    before = run.before[begin:end]
    sizes = [np.fromiter(map(len, x), np.uint8, end - begin) for x in (tails, before)]
    return zstandard.ZstdCompressor(1).compress(b"".join([
        (end - begin).to_bytes(4, "little"), common.tobytes(), *(x.tobytes() for x in sizes),
        run.text[begin:end].astype("<u4").tobytes(), run.at[begin:end].astype("<u8").tobytes(), *tails, *before]))


def opened(body: bytes) -> Run:
    """The run whose front-coded bytes these are."""
    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int.from_bytes(raw[:4], "little")
    common, sizes, left = (np.frombuffer(raw, np.uint8, n, 4 + i * n) for i in range(3))
    text = np.frombuffer(raw, "<u4", n, 4 + 3 * n).astype(np.int64)
    at = np.frombuffer(raw, "<u8", n, 4 + 7 * n).astype(np.int64)
    place, suffix, suffixes, before = 4 + 15 * n, b"", [], []
    for c, size in zip(common.tolist(), sizes.tolist()):
        suffix = suffix[:c] + raw[place: place + size]
        suffixes.append(suffix)
        place += size
    for size in left.tolist():
        before.append(raw[place: place + size])
        place += size
    return Run(suffixes, common.tolist(), before, text, at)


def _mismatch(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    least = min(len(a), len(b))
    while known < least and a[known: known + 16] == b[known: known + 16]:
        known += 16
    if known >= least:
        return least
    while known < least and a[known] == b[known]:
        known += 1
    return known


def merged(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, place in it, common prefix with the suffix before) of all suffixes in order.

    A loser tree: each inner node holds the run that lost there and the common
    prefix with the winner it lost to.  Of two suffixes not below the last one
    given, that with the longer common prefix with it comes first, so bytes
    are looked at only where both prefixes are equally long, and only beyond.
    """
    leaves = 1 << max(0, (len(runs) - 1).bit_length())
    place = [0] * leaves
    suffix: list[bytes] = [r.suffixes[0] if r.suffixes else b"" for r in runs] + [b""] * (leaves - len(runs))
    known = [0 if r.suffixes else -1 for r in runs] + [-1] * (leaves - len(runs))
    held, shared = [0] * leaves, [-1] * leaves  # of each inner node, from 1 on

    def winner(node: int) -> tuple[int, int]:
        """Plays all games below ``node``."""
        if node >= leaves:
            return node - leaves, known[node - leaves]
        (a, la), (b, lb) = winner(2 * node), winner(2 * node + 1)
        if la == lb >= 0:
            both = _mismatch(suffix[a], suffix[b], la)
            if suffix[b][both:] < suffix[a][both:]:
                a, b = b, a
            lb = both
        elif la < lb:
            a, la, b, lb = b, lb, a, la
        held[node], shared[node] = b, lb
        return a, la

    run, common = winner(1)
    while common >= 0:
        yield run, place[run], common
        at = place[run] = place[run] + 1
        own = runs[run]
        if at < len(own.suffixes):
            suffix[run], common = own.suffixes[at], own.common[at]
        else:
            common = -1
        node = (run + leaves) >> 1
        while node:
            other = shared[node]
            if common < other:
                held[node], shared[node], run, common = run, common, held[node], other
            elif common == other >= 0:
                rival = held[node]
                a, b = suffix[run], suffix[rival]
                both = _mismatch(a, b, common)
                if b[both:] < a[both:]:
                    held[node], run = run, rival
                shared[node] = both
            node >>= 1


def repeated_windows(runs: list[Run]) -> np.ndarray:
    """(run, place, bytes of the first and the last window before the anchor) of windows that stand in several places.

    Windows with ``t`` bytes before the anchor are equal if their suffixes
    have WINDOW - t bytes in common and the bytes before it t: the common
    prefixes cut both orders into groups, and windows in one group of each
    are the same.
    """
    merge = np.array(list(merged(runs)), np.int64).reshape(-1, 3)
    if not len(merge):
        return np.zeros((0, 4), np.int64)
    before = [runs[r].before[i] for r, i in merge[:, :2].tolist()]
    most = np.fromiter(map(len, before), np.int64, len(before))
    least = WINDOW + HEAD - np.array([len(runs[r].suffixes[i]) for r, i in merge[:, :2].tolist()])
    back = np.array(sorted(range(len(before)), key=before.__getitem__), np.int64)
    ahead = common_prefixes([before[i] for i in back.tolist()])
    repeated = np.zeros((len(merge), SPREAD + 1), bool)  # one column more, so that stretches end
    group = np.zeros(len(merge), np.int64)
    for t in range(SPREAD):
        rows = np.flatnonzero((least <= t) & (t <= most))
        if len(rows) < 2:
            continue
        right = np.cumsum(merge[:, 2] < HEAD + WINDOW - t)
        group[back] = np.cumsum(ahead < t)
        both = right[rows] * (len(merge) + 1) + group[rows]
        order = np.argsort(both)
        same = np.flatnonzero(both[order[1:]] == both[order[:-1]])
        repeated[rows[order[same]], t] = repeated[rows[order[same + 1]], t] = True
    row, low = np.nonzero(repeated[:, :-1] & ~np.pad(repeated[:, :-2], ((0, 0), (1, 0))))
    _, high = np.nonzero(repeated[:, :-1] & ~repeated[:, 1:])
    return np.column_stack([merge[row, 0], merge[row, 1], low, high])
