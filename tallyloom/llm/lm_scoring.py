"""Language-model scores of whole documents: a gated recurrent model and a counted base.

1. One pass over all documents writes, for blocks of about ``BLOCK`` tokens,
   the tokens as numbers of the block's own words, and the training counts of
   those words in pieces by hash.
2. The pieces of one hash range meet in one task, which adds up the counts of
   each word over all blocks and sends the totals back to the blocks.  A word
   travels once per block that has it, however often it occurs.
3. The most frequent words of all training documents are the vocabulary of the
   recurrent model.  It is trained on every token of every training document:
   in each of ``ROUNDS`` rounds each task learns from a share of its blocks,
   starting from the same weights, and the weights of all tasks are averaged by
   the tokens they learned from.  Each block is in one round, so every training
   token is learned from once, in tables of any size.
4. The blocks are scored with the model, blocks and totals meet, and each
   document gets its sums.

A word outside the model's vocabulary has the chance of the outside class
times (c + 1) / (n + v + 1) with its count c, and n tokens and v distinct
words outside the vocabulary in training.

Words are known by 64-bit hashes.  Defined results: a null text is an empty
one, whose only token is the end; a null id counts as remainder 0; equal rows
are separate documents, and equal texts get equal scores up to rounding; with
no training document every count is 0; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.labelled import remainder
from tallyloom.llm.recurrent import MEMBERS, OTHERS, WORDS, Adam, GatedModel  # noqa: F401
from tallyloom.llm.words import mix, words_of
from tallyloom.workspace import materialise

ROUNDS, RATE = 4, 0.01
SLICES = 32  # the weights are averaged in so many parts
BLOCK = 1 << 20
TOGETHER = 2  # blocks scored at once: a long document lasts for more steps than most lanes of one block have
PIECE_BYTES = 16 << 20  # text whose words one hash range holds
END = np.uint64(mix(np.array([1], np.uint64))[0])


class Language:
    """A model with its vocabulary: sorted word hashes, and the number of each."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, outside: int) -> None:
        """``words``: the vocabulary, most frequent first, with its training ``counts``; ``outside``: tokens of other words."""
        order = np.argsort(words)
        self.known, self.number = words[order], order
        self.outside = outside
        self.model = GatedModel()
        share = np.zeros(WORDS + 1)
        share[: len(counts)], share[WORDS] = counts, outside
        self.model.begin(share)

    def places(self, words: np.ndarray) -> np.ndarray:
        """Vocabulary numbers; those outside it follow WORDS, by hash."""
        at = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        other = WORDS + (words % np.uint64(OTHERS)).astype(np.int64)
        return np.where(self.known[at] == words, self.number[at], other)

    def numbered(self, words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and targets of documents laid end to end, whose ``tokens`` are places in ``words``."""
        targets = self.places(words)[tokens]
        inputs = np.concatenate([[0], targets[:-1]])
        inputs[np.cumsum(sizes) - sizes] = WORDS + OTHERS  # begin of a document
        return inputs, targets


def _blob(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes())


def _array(blob, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(bytes(blob)), kind)


_BLOCKS = ("_block long, _piece int, _words binary, _counts binary, _ids array<long>, _held array<boolean>, "
           "_sizes array<int>, _tokens binary, _trained long")
_NAMES = [c.split()[0] for c in _BLOCKS.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()),
          pa.binary(), pa.int64()]


def _block(number: int, ids: list, held: list, hashes: list, pieces: int) -> pa.RecordBatch:
    """One row with the documents of a block and its words, and one per piece of its words."""
    sizes = np.array([len(h) + 1 for h in hashes], np.int64)
    words = np.concatenate([x for h in hashes for x in (h, [END])]).astype(np.uint64)
    coded = pa.array(words).dictionary_encode()
    distinct = coded.dictionary.to_numpy()
    order = np.argsort(distinct)
    distinct, own = distinct[order], np.argsort(order)[coded.indices.to_numpy()]
    teach = np.repeat(~np.array(held, bool), sizes)
    counts = np.bincount(own[teach], minlength=len(distinct))
    rows = [[number, None, _blob(distinct), None, ids, held, sizes.tolist(), _blob(own.astype("<u4")), int(teach.sum())]]
    piece = (distinct >> np.uint64(64 - pieces)).astype(np.int64) if pieces else np.zeros(len(distinct), np.int64)
    edges = np.searchsorted(piece, np.arange((1 << pieces) + 1))
    for p in np.unique(piece):
        part = slice(edges[p], edges[p + 1])
        rows.append([number, int(p), _blob(distinct[part]), _blob(counts[part].astype("<u4")), *[None] * 5])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def _encode(pieces: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, hashes, size = [], [], [], 0
        for b in batches:
            names, out = b.column("_id").to_pylist(), b.column("_held").to_pylist()
            for at, found, counts in words_of(b.column("_text")):
                for i, part in enumerate(np.split(found, np.cumsum(counts)[:-1])):
                    ids.append(names[at + i])
                    held.append(out[at + i])
                    hashes.append(part)
                    size += len(part) + 1
                    if size >= BLOCK:
                        yield _block(number, ids, held, hashes, pieces)
                        number, ids, held, hashes, size = number + 1, [], [], [], 0
        if ids:
            yield _block(number, ids, held, hashes, pieces)
    return run


def _totals(rows: pa.Table) -> pa.Table:
    """The counts of each block's words over all blocks, the range's most frequent words, and how many it has in training."""
    words = [_array(x, "<u8") for x in rows.column("_words").to_pylist()]
    counts = [_array(x, "<u4") for x in rows.column("_counts").to_pylist()]
    distinct, which = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(which, np.concatenate(counts), len(distinct)).astype("<u8")
    out = np.split(total[which], np.cumsum([len(w) for w in words])[:-1])
    most = np.lexsort((distinct, -total.astype(np.int64)))[:WORDS]
    most = most[total[most] > 0]
    rest = [None] * (rows.num_rows - 1)
    return pa.table({"_block": rows.column("_block"), "_piece": rows.column("_piece"),
                     "_total": pa.array([_blob(x) for x in out], pa.binary()),
                     "_kinds": pa.array([int((total > 0).sum()), *rest], pa.int64()),
                     "_most": pa.array([distinct[most].astype(np.int64).tolist(), *rest], pa.list_(pa.int64())),
                     "_most_counts": pa.array([total[most].astype(np.int64).tolist(), *rest], pa.list_(pa.int64()))})


def _learned(language, number: int):
    """The weights after learning from each task's blocks of this round, in slices, times its tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, adam, learned = None, Adam(RATE * (1 - number / ROUNDS)), 0
        for b in batches:
            for row in b.to_pylist():
                sizes = np.array(row["_sizes"], np.int64)
                chosen = ~np.array(row["_held"], bool)
                if not chosen.any():
                    continue
                tokens = _array(row["_tokens"], "<u4")[np.repeat(chosen, sizes)]
                mine = mine or copy.deepcopy(language.value)
                mine.model.learn(*mine.numbered(_array(row["_words"], "<u8"), tokens, sizes[chosen]), sizes[chosen], adam)
                learned += len(tokens)
        if learned:
            parts = np.array_split(mine.model.weights().astype(float) * learned, SLICES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([x.tobytes() for x in parts], pa.binary()),
                 pa.array([learned] * SLICES, pa.int64())], ["_slice", "_weights", "_learned"])
    return run


def _summed(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, learned = 0.0, 0
    for b in batches:
        for weights, n in zip(b.column("_weights").to_pylist(), b.column("_learned").to_pylist()):
            total, learned = total + np.frombuffer(weights), learned + n
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary()), pa.array([learned], pa.int64())],
        ["_slice", "_weights", "_learned"])


_SCORED = ("_block long, _ids array<long>, _held array<boolean>, _sizes array<int>, _tokens binary, "
           "_model array<double>, _outside array<int>, _vocabulary binary")


def _scored(language):
    """The block rows with the recurrent model's scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, outside, marks = [], [], []
            rows = b.to_pylist()
            for some in (rows[i: i + TOGETHER] for i in range(0, len(rows), TOGETHER)):
                laid = []
                for row in some:
                    distinct, sizes = _array(row["_words"], "<u8"), np.array(row["_sizes"], np.int64)
                    inputs, targets = language.value.numbered(distinct, _array(row["_tokens"], "<u4"), sizes)
                    laid.append((inputs, targets, sizes))
                    outside.append(np.add.reduceat(targets >= WORDS, np.cumsum(sizes) - sizes, dtype=np.int64).tolist())
                    marks.append(_blob(np.packbits(language.value.places(distinct) < WORDS)))
                found = language.value.model.score(*map(np.concatenate, zip(*laid))) / math.log(10)
                scores += [x.tolist() for x in np.split(found, np.cumsum([len(sizes) for *_, sizes in laid])[:-1])]
            kept = [c for c in b.schema.names if c != "_words"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(scores, pa.list_(pa.float64())), pa.array(outside, pa.list_(pa.int32())),
                 pa.array(marks, pa.binary())], [*kept, "_model", "_outside", "_vocabulary"])
    return run


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _finish(trained: int, kinds: int, trained_outside: int, kinds_outside: int):
    def run(blocks: pa.Table, totals: pa.Table) -> pa.Table:
        totals = totals.sort_by("_piece")
        counts = np.concatenate([_array(x, "<u8") for x in totals.column("_total").to_pylist()]).astype(float)
        row = {c: blocks.column(c)[0].as_py() for c in blocks.column_names}
        tokens = _array(row["_tokens"], "<u4")
        sizes = np.array(row["_sizes"], np.int64)
        starts = np.cumsum(sizes) - sizes
        logs = np.log10(counts + 1)
        inside = np.unpackbits(np.frombuffer(zstandard.decompress(row["_vocabulary"]), np.uint8), count=len(counts)).astype(bool)
        base = np.add.reduceat(logs[tokens], starts) - sizes * math.log10(trained + kinds + 1)
        outside = np.add.reduceat(np.where(inside, 0.0, logs)[tokens], starts)
        score = np.array(row["_model"]) + outside - np.array(row["_outside"]) * math.log10(trained_outside + kinds_outside + 1)
        known = np.add.reduceat((counts > 0)[tokens], starts, dtype=np.int64)
        return pa.table({"doc_id": pa.array(row["_ids"], pa.int64()), "held_out": pa.array(row["_held"], pa.bool_()),
                         "n_tokens": pa.array(sizes), "n_known": pa.array(known),
                         "train_tokens": pa.array(np.full(len(sizes), trained, np.int64)),
                         "base_score": pa.array(base), "score": pa.array(score)})
    return run


def first_language(totals: DataFrame, ends: int, trained: int) -> tuple[Language, int]:
    """An untrained model with the vocabulary of all training documents (``ends`` of them), and how many of its words they have."""
    most = (totals.where("_most is not null").select(F.explode(F.arrays_zip("_most", "_most_counts")).alias("_w"))
            .select(F.col("_w._most").alias("_word"), F.col("_w._most_counts").alias("_n"))
            .orderBy(F.col("_n").desc(), "_word").limit(WORDS).toArrow())
    words, counts = most.column("_word").to_numpy().astype(np.uint64), most.column("_n").to_numpy().astype(np.int64)
    if END not in words:
        words, counts = np.append(words[: WORDS - 1], END), np.append(counts[: WORDS - 1], ends)
    return Language(words, counts, trained - int(counts.sum())), int((counts > 0).sum())


def train_language(blocks: DataFrame, language: Language, trained: int) -> Language:
    """``language`` trained on all documents of ``blocks`` that are not held out."""
    spark = blocks.sparkSession
    for number in range(ROUNDS if trained else 0):
        shared = spark.sparkContext.broadcast(language)
        # a block's number is that of its task in the upper half and its own in the lower
        own = F.pmod(F.col("_block") + F.shiftright("_block", 32), F.lit(ROUNDS)) == number
        found = blocks.where(own).select("_words", "_tokens", "_held", "_sizes").mapInArrow(
            _learned(shared, number), "_slice int, _weights binary, _learned long").groupBy("_slice").applyInArrow(
            _summed, "_slice int, _weights binary, _learned long").toArrow().sort_by("_slice")
        if found.num_rows:
            sums = np.concatenate([np.frombuffer(x) for x in found.column("_weights").to_pylist()])
            language.model.load(sums / found.column("_learned")[0].as_py())
        shared.unpersist()
    return language


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), (remainder(F.col("doc_id"), 7) == 2).alias("_held"),
                       F.col("text").alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    pieces = max(4, math.ceil(math.log2(max(1, size / PIECE_BYTES))))
    written = materialise(rows.mapInArrow(_encode(pieces), _BLOCKS), "blocks")
    totals = materialise(written.where("_piece is not null").select("_block", "_piece", "_words", "_counts")
                         .groupBy("_piece").applyInArrow(
        _totals, "_block long, _piece int, _total binary, _kinds long, _most array<long>, _most_counts array<long>"), "totals")
    blocks = written.where("_piece is null").drop("_piece", "_counts")
    taught = F.sum(F.size(F.filter("_held", lambda h: ~h)))
    trained, ends = (x or 0 for x in blocks.agg(F.sum("_trained"), taught).first())
    kinds = totals.agg(F.sum("_kinds")).first()[0] or 0
    language, inside = first_language(totals, ends, trained)
    shared = spark.sparkContext.broadcast(train_language(blocks, language, trained))
    scored = blocks.drop("_trained").mapInArrow(_scored(shared), _SCORED)
    return scored.groupBy("_block").cogroup(
        totals.select("_block", "_piece", "_total").groupBy("_block")).applyInArrow(
        _finish(trained, kinds, language.outside, kinds - inside), _RESULT)
