"""Quality classifier: naive Bayes support vectors.

A document is the set of its n-grams: runs of four bytes, words, pairs of
words, and whether a word repeats one just before it.  Each n-gram's indicator is scaled
by the log-ratio of its counts in good and bad labelled documents, the vector
is divided by the root of the number of n-grams, and a linear hinge-loss model
with a weight per class is fitted by dual coordinate descent.  A part of the
sample is kept from the fit to turn margins into scores from 0 to 1.

The fit uses at most ``labelled.SAMPLE`` labelled rows; every document is
scored over its whole text, and score and label see nothing but the text.

Defined results: a null text is an empty one, which has no n-grams and gets
the score of the bare threshold; labels that are null or belong to no
document are not used; without any label, or with labels of one class only,
every score is (good + 1) / (all + 2); equal texts get equal scores; an empty
table gives no rows; other columns are not read, or kept by ``keep_good``.
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

BITS = 18
GRAM = 4
KEEP = 0.7
COST = 1.0
PASSES = 12


def ngrams(texts: pa.Array) -> Iterator[np.ndarray]:
    """Distinct n-gram numbers below 2**BITS of each text in turn."""
    data, cuts = raw_bytes(texts)
    shift = np.uint64(64 - BITS)
    for at, to, hashes, counts, _, _ in located_words(data, cuts):
        ends = np.cumsum(counts)
        for i in range(to - at):
            raw = data[cuts[at + i]: cuts[at + i + 1]].astype(np.uint64)
            words = hashes[ends[i] - counts[i]: ends[i]]
            with np.errstate(over="ignore"):
                parts = [words >> shift, mix(words[1:] * np.uint64(3) + words[:-1]) >> shift]
                if len(raw) >= GRAM:
                    n = len(raw) - GRAM + 1
                    code = sum(raw[j: n + j] << np.uint64(8 * j) for j in range(GRAM))
                    parts.append(mix(code + np.uint64(1)) >> shift)
            for back in (1, 2):
                again = words[back:] == words[:-back]
                for run in (1, 2, 4):
                    # that many words in a row that repeat
                    if len(again) >= run and np.convolve(again, np.ones(run), "valid").max() == run:
                        parts.append(mix(np.array([back * 100 + run], np.uint64)) >> shift)
            yield np.unique(np.concatenate(parts).astype(np.uint32))


class Model(NamedTuple):
    weights: np.ndarray  # per n-gram, already times its log-count ratio
    bias: float
    slope: float
    shift: float

    def margin(self, grams: np.ndarray) -> float:
        return float(self.weights[grams].sum()) / max(1.0, len(grams)) ** 0.5 + self.bias

    def score(self, grams: np.ndarray) -> float:
        z = self.slope * self.margin(grams) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def descend(rows: list[np.ndarray], scale: np.ndarray, sign: np.ndarray, cost: np.ndarray,
            passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model over indicator rows scaled by ``scale``, by dual coordinate descent."""
    weight, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))

    def values(i: int) -> np.ndarray:
        # made anew at each visit: kept, they would take the driver as much memory as the sample
        return (scale[rows[i]] / max(1.0, len(rows[i])) ** 0.5).astype(np.float32)

    norms = np.array([float(v @ v) + 1 for v in map(values, range(len(rows)))])
    random = np.random.default_rng(1)
    for _ in range(passes):
        moved = 0.0
        for i in random.permutation(len(rows)):
            own = values(i)
            gradient = sign[i] * (weight[rows[i]] @ own + bias) - 1
            changed = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            step = (changed - alpha[i]) * sign[i]
            if step:
                weight[rows[i]] += step * own
                bias += step
                alpha[i] = changed
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weight, bias


def calibrate(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), slope above 0."""
    up, down = good.sum(), (1 - good).sum()
    aim = np.where(good == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - aim) * margins).sum() + 1e-3 * (a - 1), (p - aim).sum()])
        h = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], good: np.ndarray) -> Model:
    good = np.asarray(good, int)
    zero = np.zeros(1 << BITS)
    if len(set(good.tolist())) < 2:
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(zero.astype(np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    test = np.arange(len(rows)) % 5 == 4
    if len(set(good[test].tolist())) < 2 or len(set(good[~test].tolist())) < 2:
        test[:] = False
    counts = np.ones((2, 1 << BITS))
    for i in np.flatnonzero(~test):
        counts[good[i], rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[(counts[0] == 1) & (counts[1] == 1)] = 0  # never seen
    train = np.flatnonzero(~test)
    share = np.bincount(good[train], minlength=2) / len(train)
    cost = COST / (2 * share[good[train]])
    weight, bias = descend([rows[i] for i in train], ratio, np.where(good[train] == 1, 1.0, -1.0), cost)
    model = Model((weight * ratio).astype(np.float32), bias, 1.0, 0.0)
    held = np.flatnonzero(test) if test.any() else train
    return model._replace(**dict(zip(("slope", "shift"), calibrate(
        np.array([model.margin(rows[i]) for i in held]), good[held]))))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    return fit(*sample_features(docs, labels, "quality", ngrams, most))


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name``; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != name]
    schema = StructType([*docs.select(*kept).schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few_rows(batches):
            scores = [shared.value.score(g) for g in ngrams(b.column("text"))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, name])

    return docs.select(*kept).mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= KEEP).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, columns as they were."""
    name = "_quality"
    while name in docs.columns:
        name += "_"
    return with_score(docs, train(docs, labels), name).where(F.col(name) >= least).drop(name)
