"""Hard negatives: rows of another label that score nearly as high as an anchor's positives.

Anchors are grouped around directions by k-means.  For an anchor q in a group
of direction p, whose members lie within an angle b of p, a row o at an angle g
from p has q.o <= |q| |o| cos(max(0, g - b)).  The bound without |q| is one
number for row and group, so each group has one list of all rows in falling
order of it, made once and cut into stretches; every member walks this list
and stops where |q| times the bound falls below what it already has.

The list is walked twice, for positives and then for negatives, and each time
in two legs.  The first leg is the head of the list.  What a member has after
it says how far down it must go at most; the second leg holds each group's
list down to the least of those, and a member is sent only to the stretches
above its own.  Legs are cut into blocks that are walked in parallel.  So rows
are only sent to groups that some member needs them for, and no group's list is
ever in one task.  Equal vectors of one label are one row of the lists.

Defined results: rows with a null id or label, a null vector or a null or
non-finite component take no part, nor do those with a component of 1e150 or
more after scaling; shorter vectors count as ending in zeros; a score that no
long can hold is left out; a row that stands twice counts once; an id that
stands on unlike rows is several rows, none of which is its own positive; an
anchor without positives or a positive without negatives gives no rows; other
columns are not read.  The driver holds at most ``GROUPS`` directions and one
count for each group and bin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.vectors import NO_SCORE, leading, matrix, moderate, scaled_whole, usable, whole_products
from tallyloom.workspace import materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST = 50, 95  # a negative's score in percent of the positive's
MEMBERS = 512  # anchors that a direction stands for on average, and the most that walk together
GROUPS = 1024
SAMPLE = 16_384  # anchors that the directions are fitted to
HEAD = 4096  # rows of a list's head
BLOCK = 4096  # rows of a list walked by one task, about
STEP = 512  # rows looked at between two looks at the bound
BINS = 128  # of a list's bounds
SLACK = 1e-9
TURN = 1e-7  # what rounding can change in an angle


def _angles(x: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and angles to each direction (0 for a zero vector)."""
    size = np.linalg.norm(x, axis=1)
    cosine = (x / np.where(size > 0, size, 1)[:, None]) @ directions.T
    cosine[size == 0] = 1
    return size, np.arccos(np.clip(cosine, -1, 1))


def directions_of(sample: np.ndarray, groups: int, rounds: int = 8) -> np.ndarray:
    """Unit directions by k-means on the sphere, begun at rows far from each other."""
    size = np.linalg.norm(sample, axis=1)
    unit = sample[size > 0] / size[size > 0][:, None]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    chosen, near = [0], unit @ unit[0]
    while len(chosen) < min(groups, len(unit)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    found = unit[chosen]
    for _ in range(rounds):
        nearest = (unit @ found.T).argmax(1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, unit)
        length = np.linalg.norm(sums, axis=1)
        found = np.where((length > 0)[:, None], sums / np.where(length > 0, length, 1)[:, None], found)
    return found


def _grouped(directions: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, angle = _angles(matrix(b.column("_vec"), directions.shape[1], float), directions)
            group = angle.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(group, pa.int32()), pa.array(angle[np.arange(len(group)), group]), pa.array(size)],
                [*b.schema.names, "_group", "_angle", "_size"])
    return run


class Lists:
    """The bounds that order each group's list, and where its bins begin."""

    def __init__(self, directions: np.ndarray, reach: np.ndarray, top: float) -> None:
        self.directions, self.reach, self.top = directions, reach, top

    def bounds(self, x: np.ndarray) -> np.ndarray:
        size, angle = _angles(x, self.directions)
        return size[:, None] * np.cos(np.maximum(0, angle - self.reach - TURN))

    def bins(self, bounds: np.ndarray) -> np.ndarray:
        """0 for the highest bounds."""
        return np.clip(((self.top - bounds) / (2 * self.top) * BINS).astype(np.int64), 0, BINS - 1)

    def top_of(self, bin_: int) -> float:
        return self.top * (1 - 2 * bin_ / BINS)


def _histogram(lists: Lists):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = len(lists.directions)
        counts = np.zeros((groups, BINS), np.int64)
        for b in batches:
            bins = lists.bins(lists.bounds(matrix(b.column("_vec"), lists.directions.shape[1], float)))
            counts += np.bincount((bins + np.arange(groups) * BINS).ravel(), minlength=groups * BINS).reshape(groups, BINS)
        group, bin_ = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), pa.array(bin_, pa.int32()), pa.array(counts[group, bin_])],
                                         ["_group", "_bin", "n"])
    return run


class Leg:
    """The bins of each group's list from ``begin`` up to, not with, ``end``, cut into stretches and parts."""

    def __init__(self, lists: Lists, counts: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        self.lists = lists
        before = np.cumsum(counts, 1) - counts
        inside = (np.arange(BINS) >= begin[:, None]) & (np.arange(BINS) < end[:, None])
        self.stretch = np.where(inside, before // BLOCK, -1)
        self.parts = np.maximum(1, -(-counts // BLOCK))

    def rows(self) -> list[tuple[int, int, int, float]]:
        """(group, stretch, number of parts, highest bound); no more rows than there are groups and bins."""
        found: dict[tuple[int, int], list[float]] = {}
        for g, b in zip(*np.nonzero(self.stretch >= 0)):
            block = found.setdefault((int(g), int(self.stretch[g, b])), [1, -np.inf])
            block[0], block[1] = max(block[0], int(self.parts[g, b])), max(block[1], self.lists.top_of(int(b)))
        return [(g, s, int(parts), float(top)) for (g, s), (parts, top) in found.items()]

    def send(self):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bounds = self.lists.bounds(matrix(b.column("_vec"), self.lists.directions.shape[1], float))
                bins, groups = self.lists.bins(bounds), np.arange(bounds.shape[1])
                stretch = self.stretch[groups, bins]
                row, group = np.nonzero(stretch >= 0)
                part = b.column("_hash").to_numpy()[row] % self.parts[group, bins[row, group]]
                taken = b.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group, pa.int32()), pa.array(stretch[row, group], pa.int32()), pa.array(part, pa.int32()),
                     pa.array(bounds[row, group]), *(taken.column(c) for c in ("_vid", "_first", "_label", "_vec"))],
                    ["_group", "_stretch", "_part", "_bound", "_other", "_of", "_label", "_vec"])
        return run


_FOUND = pa.schema([("_vid", pa.int64()), ("_cap", pa.int64()), ("_other", pa.int64()), ("_of", pa.int64()), ("_score", pa.int64())])


def _walk(width: int, k: int, same: bool):
    """Members against one block of a list, in falling order of the bound, each until it can find nothing more.

    A member asks one question, or one for each ``_caps``: the k highest scores
    among rows of its label (``same``) or of others, not below ``_lows`` and not
    above ``_caps``.  ``_stops`` are scores that are sure not to be undercut.
    """
    def run(data: pa.Table, members: pa.Table) -> pa.Table:
        if not data.num_rows or not members.num_rows:
            return _FOUND.empty_table()
        data = data.sort_by([("_bound", "descending"), ("_of", "ascending"), ("_other", "ascending")])
        o, q = (matrix(t.column("_vec"), width, float) for t in (data, members))
        bound, first, other, label = (data.column(c).to_numpy() for c in ("_bound", "_of", "_other", "_label"))
        size, mine, name = (members.column(c).to_numpy() for c in ("_size", "_label", "_vid"))
        questions = members.column("_caps").combine_chunks()
        who = np.repeat(np.arange(len(q)), np.diff(questions.offsets.to_numpy()))
        cap = questions.flatten().to_numpy()
        low, stop = (members.column(c).combine_chunks().flatten().to_numpy() for c in ("_lows", "_stops"))
        best = np.full((len(who), k), NO_SCORE, np.int64)
        parts = []
        for begin in range(0, len(o), STEP):
            least = np.maximum(stop, best[:, -1]).astype(float)
            reach = size[who] * bound[begin]
            going = np.flatnonzero(reach + SLACK * (1 + np.abs(reach)) >= least)
            if not len(going):
                break
            people, place = np.unique(who[going], return_inverse=True)
            scores = whole_products(q[people], o[begin: begin + STEP])[place]
            alike = mine[who[going]][:, None] == label[begin: begin + STEP]
            fits = (alike == same) & (scores <= cap[going][:, None]) & (scores >= low[going][:, None]) & (scores > NO_SCORE)
            scores = np.where(fits, scores, NO_SCORE)
            row, col = leading(scores, first[begin: begin + STEP], k)
            real = scores[row, col] > NO_SCORE
            row, col = row[real], col[real]
            parts.append((going[row], begin + col, scores[row, col]))
            top = np.full((len(going), k), NO_SCORE, np.int64)
            top[row, np.arange(len(row)) - np.searchsorted(row, row)] = scores[row, col]
            best[going] = -np.sort(-np.concatenate([best[going], top], 1), 1)[:, :k]
        if not parts:
            return _FOUND.empty_table()
        question, col, score = (np.concatenate(x) for x in zip(*parts))
        kept = score >= best[question, -1]
        question, col, score = question[kept], col[kept], score[kept]
        return pa.table([name[who[question]], cap[question], other[col], first[col], score], schema=_FOUND)
    return run


class _Search:
    """Lists over ``items``, and walks of ``members`` along them."""

    def __init__(self, items: DataFrame, members: DataFrame, width: int) -> None:
        self.items, self.width = items, width
        spark = items.sparkSession
        count = members.count()
        groups = min(GROUPS, max(1, math.ceil(count / MEMBERS)))
        sample = members.orderBy(F.xxhash64("_vec"), "_vid").limit(min(SAMPLE, 16 * groups + 256)).select("_vec").toArrow()
        directions = directions_of(matrix(sample.column(0), width, float), groups) if sample.num_rows else np.eye(1, width)
        self.members = materialise(members.mapInArrow(_grouped(directions), (
            "_vid long, _label int, _vec array<double>, _group int, _angle double, _size double")), "members")
        reach = np.zeros(len(directions))
        sizes = np.zeros(len(directions), np.int64)
        for r in self.members.groupBy("_group").agg(F.max("_angle").alias("a"), F.count(F.lit(1)).alias("n")).collect():
            reach[r["_group"]], sizes[r["_group"]] = r["a"], r["n"]
        longest = items.agg(F.max(F.aggregate("_vec", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0
        self.lists = Lists(directions, reach, max(1.0, math.sqrt(longest) * (1 + SLACK)))
        self.counts = np.zeros((len(directions), BINS), np.int64)
        for r in items.select("_vec").mapInArrow(_histogram(self.lists), "_group int, _bin int, n long").groupBy(
                "_group", "_bin").agg(F.sum("n").alias("n")).collect():
            self.counts[r["_group"], r["_bin"]] = r["n"]
        self.counts[sizes == 0] = 0
        self.parts = spark.createDataFrame([(g, max(1, math.ceil(int(n) / MEMBERS))) for g, n in enumerate(sizes)], "_group int, _teams long")
        # the head: bins until it has HEAD rows
        self.head = np.minimum(BINS, (np.cumsum(self.counts, 1) < HEAD).sum(1) + 1)

    def leg(self, members: DataFrame, begin: np.ndarray, end: np.ndarray, k: int, same: bool) -> DataFrame:
        """What ``members`` (with _caps, _lows, _stops, _least) find in those bins."""
        spark = self.items.sparkSession
        leg = Leg(self.lists, self.counts, begin, end)
        blocks = spark.createDataFrame(leg.rows(), "_group int, _stretch int, _parts int, _top double")
        data = self.items.mapInArrow(leg.send(), (
            "_group int, _stretch int, _part int, _bound double, _other long, _of long, _label int, _vec array<double>"))
        asked = members.join(F.broadcast(self.parts), "_group").withColumn("_team", F.pmod(F.xxhash64("_vid"), "_teams")).join(
            F.broadcast(blocks), "_group").where((F.col("_size") * F.col("_top") * (1 + SLACK) + SLACK >= F.col("_least")) | (F.col("_top") <= 0)
        ).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        sent = data.join(F.broadcast(self.parts), "_group").withColumn("_team", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_teams") - 1)))
        keys = ["_group", "_stretch", "_part", "_team"]
        return sent.drop("_teams").groupBy(*keys).cogroup(
            asked.select(*keys, "_vid", "_label", "_vec", "_size", "_caps", "_lows", "_stops").groupBy(*keys)).applyInArrow(
            _walk(self.width, k, same), "_vid long, _cap long, _other long, _of long, _score long")

    def walk(self, members: DataFrame, k: int, same: bool) -> DataFrame:
        """The k best rows of every question, as a written table (_vid, _cap, _other, _of, _score)."""
        groups = len(self.counts)
        least = F.array_min("_stops").cast("double")
        head = self.head
        first = materialise(_best(self.leg(members.withColumn("_least", least), np.zeros(groups, np.int64), head, k, same), k), "head")
        # a question with k finds needs nothing below the last of them
        reached = first.groupBy("_vid", "_cap").agg(F.count(F.lit(1)).alias("n"), F.min("_score").alias("_last")).where(F.col("n") == k)
        stops = members.select("_vid", F.explode(F.arrays_zip("_caps", "_stops")).alias("z")).select(
            "_vid", F.col("z._caps").alias("_cap"), F.col("z._stops").alias("_stop")).join(reached, ["_vid", "_cap"], "left")
        certain = stops.groupBy("_vid").agg(F.sort_array(F.collect_list(
            F.struct("_cap", F.greatest("_stop", F.coalesce("_last", "_stop")).alias("stop")))).alias("z")).select(
            "_vid", F.transform("z", lambda s: s["stop"]).alias("_stops"))
        going = materialise(members.drop("_stops").join(certain, "_vid").withColumn("_least", F.array_min("_stops").cast("double")), "going")
        # each group's list goes on down to the bound that its last member stops at
        end = head.copy()
        need = F.when(F.col("_size") > 0, (F.col("_least") - SLACK * (1 + F.abs("_least"))) / F.col("_size"))
        for r in going.groupBy("_group").agg(F.min(F.coalesce(need, F.lit(-np.inf))).alias("b")).collect():
            floor = max(r["b"], -self.lists.top) if r["b"] is not None else -self.lists.top
            end[r["_group"]] = max(end[r["_group"]], int(self.lists.bins(np.array([floor - SLACK * (1 + abs(floor))]))[0]) + 1)
        if (end == head).all():
            return first
        second = self.leg(going, head, end, k, same)
        return materialise(_best(first.union(second.select(first.columns)), k), "walked")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("_vid", "_cap").orderBy(F.col("_score").desc(), "_of", "_other")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


def _first_ids(found: DataFrame, items: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best ids of each question: ``keys``, _id, _score, _rank."""
    spread = found.join(items.select(F.col("_vid").alias("_other"), "_ids"), "_other").select(*keys, "_score", F.explode("_ids").alias("_id"))
    order = W.partitionBy(*keys).orderBy(F.col("_score").desc(), "_id")
    return spread.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)


def hard_negatives(table: DataFrame, anchors: Column, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchors`` picks rows by _id."""
    rows = table.where(usable(F.col(vector)) & F.col(id_column).isNotNull() & F.col(label).isNotNull()).select(
        F.col(id_column).cast("long").alias("_id"), F.col(label).cast("int").alias("_label"), scaled_whole(F.col(vector), SCALE).alias("_vec")).where(
        moderate("_vec")).distinct()
    equal = W.partitionBy("_label", "_vec").orderBy("_id")
    items = materialise(
        rows.withColumn("_n", F.row_number().over(equal)).where(F.col("_n") <= POSITIVES + 1).groupBy("_label", "_vec").agg(
            F.sort_array(F.collect_list("_id")).alias("_ids")).select(
            F.monotonically_increasing_id().alias("_vid"), F.col("_ids")[0].alias("_first"), "_ids", "_label", "_vec",
            F.xxhash64("_label", "_vec").bitwiseAND(F.lit((1 << 40) - 1)).alias("_hash")), "items")
    asking = materialise(rows.where(anchors).join(items.select("_vid", "_label", "_vec"), ["_label", "_vec"]).select("_id", "_vid"), "asking")
    width = items.agg(F.max(F.size("_vec"))).first()[0] or 1
    members = items.join(asking.select("_vid").distinct(), "_vid", "left_semi").select("_vid", "_label", "_vec")
    search = _Search(items, members, width)

    def longs(value: int) -> Column:
        return F.array(F.lit(value).cast("long"))

    alike = search.walk(search.members.withColumns({
        "_caps": longs((1 << 63) - 1), "_lows": longs(NO_SCORE + 1), "_stops": longs(NO_SCORE + 1)}), POSITIVES + 1, True)
    # one more than wanted, as an anchor finds itself
    ranked = materialise(_first_ids(alike, items, ["_vid"], POSITIVES + 1), "alike")
    own = asking.select(F.col("_id").alias("anchor_id"), "_vid").join(ranked, "_vid").where(F.col("_id") != F.col("anchor_id"))
    order = W.partitionBy("anchor_id", "_vid").orderBy(F.col("_score").desc(), "_id")
    positives = materialise(own.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= POSITIVES).select(
        "anchor_id", "_vid", F.col("_id").alias("positive_id"), F.col("_score").alias("positive_score"),
        _percent(F.col("_score"), HIGHEST, F.floor).alias("_cap"), _percent(F.col("_score"), LOWEST, F.ceil).alias("_low"))
        .where("_low <= _cap"), "positives")

    wanted = positives.groupBy("_vid", "_cap").agg(F.min("_low").alias("_low")).groupBy("_vid").agg(
        F.sort_array(F.collect_list(F.struct("_cap", "_low"))).alias("z")).select(
        "_vid", F.transform("z", lambda s: s["_cap"]).alias("_caps"), F.transform("z", lambda s: s["_low"]).alias("_lows"),
        F.transform("z", lambda s: s["_low"]).alias("_stops"))
    others = search.walk(search.members.join(wanted, "_vid"), NEGATIVES, False)
    negatives = _first_ids(others, items, ["_vid", "_cap"], NEGATIVES)
    return positives.join(negatives, ["_vid", "_cap"]).where(F.col("_score") >= F.col("_low")).withColumn(
        "rank", F.row_number().over(W.partitionBy("anchor_id", "_vid", "positive_id").orderBy(F.col("_score").desc(), "_id"))).select(
        "anchor_id", "positive_id", "rank", F.col("_id").alias("negative_id"), "positive_score", F.col("_score").alias("negative_score"))


def _percent(score: Column, percent: int, rounding) -> Column:
    """``percent`` of a score, rounded exactly."""
    exact = score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")
    return rounding(exact.cast("decimal(28,2)")).cast("long")
