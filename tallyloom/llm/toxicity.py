"""Toxicity by cumulative-link ordinal regression.

Severity has grades 0 (clean) to 3.  The chance of a grade above k is
logistic(w.x - t_k) with one weight vector w for all thresholds
t_0 < t_1 < t_2, so evidence for "worse" is shared between grades; the output
is the expected severity, the sum of those chances.  x holds log(1 + count) of
those words without marks, and first bytes of words, that differ clearly in
frequency between clean and toxic rows.

The labels say only whether a document is toxic.  The grade of a toxic one
comes from its marks: a mark is a word or word begin that occurs in
``MARK_ROWS`` or more toxic rows of the sample and, per row, ``MARK_RATIO`` times
as often as in clean ones; with fewer than ``MARKS[0]`` occurrences the grade is
1, with fewer than ``MARKS[1]`` 2, else 3.

The fit uses at most ``labelled.SAMPLE`` labelled rows; every document is
scored over its whole text.  Defined results: a null text is an empty one,
without features; labels that are null or belong to no document are not used;
without toxic labels every severity is 0; equal texts get equal severities; an
empty table gives no rows; other columns are not read, or kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyloom.llm.labelled import SAMPLE, remainder, sample_features
from tallyloom.llm.words import few_rows, located_words, mix, raw_bytes

BITS = 20
GRADES = 4
BEGIN = 5  # bytes of a word's begin
MARK_ROWS, MARK_RATIO = 4, 20.0
MARKS = (3, 7)
LIMIT = 0.5  # expected severity from which a document is toxic
Z, RATIO = 5.0, 20.0  # features enter the model when clean and toxic rows differ by so many standard errors and times
STEPS, RATE, SHRINK = 400, 0.15, 1e-6

_MARKS_TO_SPACE = np.arange(256, dtype=np.uint8)
_MARKS_TO_SPACE[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Feature numbers below 2**BITS of each text in turn, once per occurrence: words, then their begins."""
    data, cuts = raw_bytes(texts)
    data = np.append(_MARKS_TO_SPACE[data], np.zeros(BEGIN, np.uint8))
    shift = np.uint64(64 - BITS)
    for at, to, hashes, counts, begins, ends in located_words(data[:-BEGIN], cuts):
        code = np.zeros(len(begins), np.uint64)
        for j in range(BEGIN):
            code |= np.where(begins + j < ends, _LOW[data[begins + j]], 0).astype(np.uint64) << np.uint64(8 * j)
        heads = mix(code + np.uint64(1)) >> shift
        words = hashes >> shift
        long = ends - begins > BEGIN
        stop = np.cumsum(counts)
        for i in range(to - at):
            own = slice(stop[i] - counts[i], stop[i])
            yield np.concatenate([words[own], heads[own][long[own]]]).astype(np.uint32)


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, found: np.ndarray) -> float:
        kinds, counts = np.unique(found, return_counts=True)
        z = float(self.weights[kinds] @ np.log1p(counts)) - self.thresholds
        return float((1 / (1 + np.exp(-np.clip(z, -500, 500)))).sum())


def grades(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grade of each labelled row."""
    size = 1 << BITS
    seen = [np.zeros(size), np.zeros(size)]
    for r, t in zip(rows, toxic):
        seen[int(t)][np.unique(r)] += 1
    many = max(1, int((toxic == 1).sum())), max(1, int((toxic == 0).sum()))
    marks = (seen[1] >= MARK_ROWS) & (seen[1] / many[0] >= MARK_RATIO * (seen[0] + 0.5) / many[1])
    out = np.zeros(len(rows), int)
    for i in np.flatnonzero(toxic == 1):
        out[i] = 1 + np.searchsorted(MARKS, int(marks[rows[i]].sum()), side="right")
    return out


def apart(rows: list[np.ndarray]) -> np.ndarray:
    """Places of rows that are no near copy of an earlier one, by two triples of smallest hashes.

    Else every word of a toxic text with many copies would look like a mark.
    """
    seen, out = set(), []
    for i, r in enumerate(rows):
        kinds = np.unique(r).astype(np.uint64)
        least = [int((mix(kinds + np.uint64(s << 40))).min(initial=0 if not len(kinds) else 2**64 - 1)) for s in range(6)]
        bands = {(0, *least[:3]), (1, *least[3:])}
        if not bands & seen:
            out.append(i)
        seen |= bands
    return np.array(out, int)


def telling(rows: list[np.ndarray], bad: np.ndarray) -> np.ndarray:
    """Which features differ between clean and toxic rows ``RATIO`` times and by ``Z`` standard errors or more."""
    size = 1 << BITS
    seen = [np.zeros(size), np.zeros(size)]
    for r, t in zip(rows, bad):
        seen[int(t)][np.unique(r)] += 1
    n = [max(1, int((~bad).sum())), max(1, int(bad.sum()))]
    share = (seen[0] + seen[1]) / (n[0] + n[1])
    error = np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1])) + 1e-12
    odds = np.log((seen[1] + 0.5) / n[1]) - np.log((seen[0] + 0.5) / n[0])
    return (np.abs(seen[1] / n[1] - seen[0] / n[0]) >= Z * error) & (np.abs(odds) >= np.log(RATIO))


def fit(rows: list[np.ndarray], grade: np.ndarray) -> Model:
    """Weights and ordered thresholds by gradient steps (Adam) on the log-likelihood of the grades."""
    if not len(rows) or not (grade > 0).any():
        return Model(np.zeros(1 << BITS, np.float32), np.full(GRADES - 1, 500.0))
    kept = telling(rows, grade > 0)
    pairs = [np.unique(r[kept[r]], return_counts=True) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(k) for k, _ in pairs])
    kind = np.concatenate([k for k, _ in pairs])
    used, column = np.unique(kind, return_inverse=True)
    value = np.log1p(np.concatenate([c for _, c in pairs]))
    weight = np.zeros(len(used))
    free = np.array([1.0, 0.0, 0.0])  # first threshold, then logs of the gaps: always in order
    above = grade[:, None] > np.arange(GRADES - 1)
    share = np.where(grade > 0, (grade == 0).sum() / (grade > 0).sum(), 1.0)
    share = np.minimum(share, 10) / len(rows)
    moment = [np.zeros(len(used) + 3), np.zeros(len(used) + 3)]
    for step in range(1, STEPS + 1):
        thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        z = np.bincount(row, value * weight[column], len(rows))
        p = 1 / (1 + np.exp(-np.clip(z[:, None] - thresholds, -30, 30)))  # chance of a grade above each threshold
        full = np.concatenate([np.ones((len(rows), 1)), p, np.zeros((len(rows), 1))], axis=1)
        own = np.maximum(full[np.arange(len(rows)), grade] - full[np.arange(len(rows)), grade + 1], 1e-12)
        slope = np.concatenate([np.zeros((len(rows), 1)), p * (1 - p), np.zeros((len(rows), 1))], axis=1)
        up = slope[np.arange(len(rows)), grade] / own
        down = slope[np.arange(len(rows)), grade + 1] / own
        dz = -(up - down) * share
        dt = np.zeros(GRADES + 1)
        np.add.at(dt, grade, up * share)
        np.add.at(dt, grade + 1, -down * share)
        dt = dt[1:GRADES]
        tail = np.cumsum(dt[::-1])[::-1]
        gradient = np.concatenate([np.bincount(column, value * dz[row], len(used)) + SHRINK * weight,
                                   tail[:1], tail[1:] * np.exp(free[1:])])
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.999 * moment[1] + 0.001 * gradient**2
        change = RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-7)
        weight -= change[:-3]
        free = np.clip(free - change[-3:], -6, 20)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = weight
    return Model(weights, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    return fit_labelled(*sample_features(docs, labels, "toxic", features, most))


def fit_labelled(rows: list[np.ndarray], toxic: np.ndarray) -> Model:
    kept = apart(rows)
    rows, toxic = [rows[i] for i in kept], np.asarray(toxic)[kept]
    return fit(rows, grades(rows, toxic))


def with_severity(docs: DataFrame, model: Model, name: str = "severity") -> DataFrame:
    """``docs`` with a double column ``name`` from 0 to 3; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != name]
    schema = StructType([*docs.select(*kept).schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few_rows(batches):
            found = [shared.value.severity(f) for f in features(b.column("text"))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], [*b.schema.names, name])

    return docs.select(*kept).mapInArrow(run, schema)


def grade_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, severity, grade, toxic."""
    scored = with_severity(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "severity",
                         F.round("severity").cast("int").alias("grade"), (F.col("severity") >= LIMIT).alias("toxic"))


def keep_clean(docs: DataFrame, labels: DataFrame, below: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` whose expected severity is under ``below``, columns as they were."""
    name = "_severity"
    while name in docs.columns:
        name += "_"
    return with_severity(docs, train(docs, labels), name).where(F.col(name) < below).drop(name)
