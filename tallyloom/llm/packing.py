"""Best-fit packing of token sequences by a configuration linear program.

Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the
driver.  There a fractional packing is built from configurations, multisets
of lengths that fill one sequence.  Each round prices lengths by
multiplicative weights, where lengths whose demand is served less than others
weigh more, finds the most valuable configurations by a knapsack dynamic
program, and uses them for a share of the demand.  Multiplicities are rounded
down to whole sequences, and what is left goes best fit decreasing, a whole
batch of equal sequences at a time, so the work depends on the number of
lengths and not on the number of documents.  Where keeping the whole fractional
packing leaves pieces that fit each other badly, the rounding keeps less of it.  Pieces then find their sequence
by length and rank among the pieces of that length.

Defined results: a null text is an empty one, whose only token is the end;
equal rows are separate documents; an empty table gives no rows; other
columns are carried by ``pack`` and not read by ``pack_documents``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.vocabularies import word_ids
from tallyloom.workspace import materialise

CAPACITY = 2048
END = 0
ROUNDS = 160  # pricing rounds
PER_ROUND = 32  # configurations taken from one dynamic program
STEP = 0.5  # share of what a configuration could serve that one use takes
RATE = 6.0  # how strongly a lag in service raises a price
PARTS = (1.0, 0.5, 0.0)  # shares of the fractional packing that the rounding may keep
SPARE = 2e-4  # it keeps the largest share that needs at most this much more than the least


class Pattern(NamedTuple):
    lengths: tuple[int, ...]  # of the pieces of one sequence, longest first
    times: int  # sequences of this kind


def knapsack(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Most value that fits into each space, and the place of the last length put there (-1: none).  Lengths ascend."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for space in range(1, capacity + 1):
        n = fits[space]
        if n:
            reach = values[:n] + best[space - lengths[:n]]
            i = int(reach.argmax())
            best[space], last[space] = reach[i], i
        if best[space - 1] > best[space]:
            best[space], last[space] = best[space - 1], -1
    return best, last


def _configuration(first: int, last: np.ndarray, lengths: np.ndarray, capacity: int) -> list[int]:
    found, space = [first], capacity - lengths[first]
    while space > 0:
        if last[space] < 0:
            space -= 1
            continue
        found.append(int(last[space]))
        space -= lengths[last[space]]
    return found


def fractional(lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY) -> dict[tuple[int, ...], float]:
    """Configurations (places of lengths) and how many sequences of each, covering at most the demand."""
    served = np.zeros(len(lengths))
    uses: dict[tuple[int, ...], float] = {}
    for _ in range(ROUNDS):
        left = demand - served
        progress = float((served * lengths).sum() / (demand * lengths).sum())
        values = lengths * np.exp(RATE * (progress - served / demand))
        values[left < 1e-9] = 0
        best, last = knapsack(values, lengths, capacity)
        open_ = np.flatnonzero(left > 1e-9)
        if not len(open_):
            break
        worth = values[open_] + best[capacity - lengths[open_]]
        changed = False
        for first in open_[np.argsort(-worth, kind="stable")[:PER_ROUND]]:
            config = _configuration(int(first), last, lengths, capacity)
            kinds, counts = np.unique(config, return_counts=True)
            if lengths[config].sum() < 0.995 * capacity:
                continue  # a loose filling is left to the rounding
            share = float(((demand - served)[kinds] / counts).min()) * STEP
            if share > 1e-9:
                served[kinds] += counts * share
                key = tuple(sorted(config, reverse=True))
                uses[key] = uses.get(key, 0) + share
                changed = True
        if not changed:
            break
    return uses


def best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Best fit decreasing over a histogram: the longest piece, then whatever leaves least space, in whole batches."""
    out, left = [], left.copy()
    while (open_ := np.flatnonzero(left > 0)).size:
        used: dict[int, int] = {}
        space = capacity
        chosen: list[int] = []
        while True:
            fit = np.searchsorted(lengths[open_], space, side="right") - 1
            while fit >= 0 and used.get(int(open_[fit]), 0) >= left[open_[fit]]:
                fit -= 1
            if fit < 0:
                break
            i = int(open_[fit])
            used[i] = used.get(i, 0) + 1
            chosen.append(i)
            space -= lengths[i]
        times = min(int(left[i] // n) for i, n in used.items())
        for i, n in used.items():
            left[i] -= n * times
        out.append(Pattern(tuple(int(lengths[i]) for i in chosen), times))
    return out


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold each length exactly as often as the histogram has it."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[int(n)] for n in lengths], dtype=np.int64)
    uses = fractional(lengths, demand.astype(float), capacity)
    plans = []
    for part in PARTS:
        out, left = [], demand.copy()
        for config, amount in uses.items():
            times = int(amount * part)
            if times:
                np.subtract.at(left, list(config), times)
                out.append(Pattern(tuple(int(lengths[i]) for i in config), times))
        plans.append(out + best_fit(lengths, left, capacity))
    needed = [sum(p.times for p in plan) for plan in plans]
    return next(plan for plan, n in zip(plans, needed) if n <= min(needed) * (1 + SPARE) + 1)


class Places:
    """Where the pieces of each length go, by rank among them."""

    def __init__(self, patterns: list[Pattern]) -> None:
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        base = 0
        for lengths, times in patterns:
            offset = 0
            for n in sorted(set(lengths), reverse=True):
                each = lengths.count(n)
                rows.setdefault(n, []).append((taken.get(n, 0), each, base, offset))
                taken[n] = taken.get(n, 0) + each * times
                offset += each * n
            base += times
        self.rows = {n: np.array(r, np.int64).T for n, r in rows.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            start, each, base, begin = self.rows[int(n)]
            i = np.searchsorted(start, rank[at], side="right") - 1
            k = rank[at] - start[i]
            sequence[at] = base[i] + k // each[i]
            offset[at] = begin[i] + (k % each[i]) * n
        return sequence, offset


def _cut(path: str, capacity: int, with_ids: bool):
    """Pieces of each document; _rank counts the pieces of a length met so far in this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        met = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        end = np.array([END], np.uint32)
        for b in batches:
            of, piece, start, length, check, rank, ids = [], [], [], [], [], [], []
            for i, found in enumerate(words.ids(b.column("_text"))):
                tokens = np.concatenate([found, end])
                for p, begin in enumerate(range(0, len(tokens), capacity)):
                    cut = tokens[begin: begin + capacity].astype("<u4")
                    of.append(i)
                    piece.append(p)
                    start.append(begin)
                    length.append(len(cut))
                    check.append(zlib.crc32(cut.tobytes()))
                    rank.append(met[len(cut)])
                    met[len(cut)] += 1
                    if with_ids:
                        ids.append(cut.astype(np.int32))
            columns = [b.column("_doc").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                       *[pa.array(x, pa.int64()) for x in (start, length, check, rank, [part] * len(of))]]
            names = ["_doc", "piece", "start", "length", "ids_crc32", "_rank", "_slice"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _assign(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places.value.find(b.column("length").to_numpy(), b.column("_rank").to_numpy())
            kept = b.drop_columns(["_rank"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence), pa.array(offset)],
                                             [*kept.schema.names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The columns of ``docs`` but for ``text``, then piece, start, length, ids_crc32, [ids,] sequence_id, offset.

    ``tokenizer`` is the place of a tokenizer file that every executor has.
    """
    made = ("text", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")
    kept = [c for c in docs.columns if c not in made]
    rows = docs.select(F.struct(*kept).alias("_doc"), F.col("text").alias("_text"))
    schema = f"_doc {rows.schema['_doc'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, _rank long, _slice long"
    schema += ", ids array<int>" if with_ids else ""
    pieces = materialise(rows.mapInArrow(_cut(tokenizer, capacity, with_ids), schema), "pieces")
    counts = pieces.groupBy("_slice", "length").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(Places(plan_sequences(histogram, capacity)))
    before = counts.select("_slice", "length", (F.sum("_n").over(
        W.partitionBy("length").orderBy("_slice")) - F.col("_n")).alias("_before"))
    tail = ["ids"] if with_ids else []
    ranked = pieces.join(before, ["_slice", "length"]).select(
        "_doc", "piece", "start", "length", "ids_crc32", *tail, (F.col("_rank") + F.col("_before")).alias("_rank"))
    kept_schema = schema.split(", _rank long")[0] + (", ids array<int>" if with_ids else "")
    return ranked.mapInArrow(_assign(places), kept_schema + ", sequence_id long, offset long").select(
        "_doc.*", "piece", "start", "length", "ids_crc32", *tail, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(docs.select("doc_id", "text"), tokenizer)
