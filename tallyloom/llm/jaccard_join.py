"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link when 100 * |A and B| >= percent * |A or B| for their sets of
word shingles.  The steps:

1. Equal sets are collapsed, so a text with many copies is joined once.
2. All shingles are put in one order, rare before frequent.  Frequency comes
   from counters of hashed shingles over all documents, one table of fixed
   size; the order need only be the same everywhere for the join to be exact.
3. A link shares all but a tenth (say) of either set, so two linked sets share
   l shingles or more within their first |A| - ceil(t|A|) + l.  Each set takes
   the l that lowers its estimated cost: a longer prefix meets more sets, but
   a candidate must then match l times before it is verified.  A pair must
   share the smaller l of the two.
4. Within each posting list all sets are first checked against a hub, so a
   large group of near copies becomes one component by a number of checks in
   proportion to its size.  Then every pair of sets in *different* components
   that shares enough prefix shingles is checked.  No list is cut short.
   Before a text is moved for a check, a small parity map of each set rules
   out most pairs that differ too much; it never rules out a link.
5. Links become components as tables.

Shingles and sets are known by 64-bit hashes.  Defined results: a text
without words, empty or null has no shingles, links with nothing and is its own
component; a text shorter than a shingle is one shingle; equal rows link; a
null id takes no part in the smallest id; an empty table gives no rows; other
columns are not read, or carried by ``keep_one``.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components, joined_components
from tallyloom.llm.mixing import WORD
from tallyloom.llm.words import few_rows, hash_words, raw_bytes, shingles, split_texts
from tallyloom.workspace import materialise, scratch_path, table_name

CELL_BITS = 20  # counters of hashed shingles
PART_BITS = 14  # counters in one row while they are added up
MATCHES = (1, 2, 4, 8, 16, 32)
LENGTHEN = 0.25  # the share by which a prefix may grow
USUAL = 0.5  # other sets that a rare shingle is taken to lead to
MAP_ROWS = 2_000  # shingles of a set up to which parity maps rule out unrelated sets
CHECK_COST = 20.0  # of verifying a pair, in posting rows read


def set_key(found: np.ndarray) -> int:
    return int.from_bytes(blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(words: int):
    """A row per document (_id, _n, _set), then a task's counters."""
    names = ["_id", "_n", "_set", "_part", "_task", "_counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for b in batches:
            size, key = [], []
            for found in (shingles(w, words) for w in split_texts(b.column("_text"))):
                size.append(len(found))
                key.append(set_key(found) if len(found) else None)
                np.add.at(counts, (found >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
            none = [None] * b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(size, pa.int64()), pa.array(key, pa.int64()),
                 pa.array(none, pa.int32()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], names)
        task = TaskContext.get().partitionId()
        parts = counts.reshape(-1, 1 << PART_BITS)
        none = [None] * len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(parts), pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.int64()),
             pa.array(range(len(parts)), pa.int32()), pa.array([task] * len(parts), pa.int32()),
             pa.array([zstandard.compress(p.astype("<i8").tobytes()) for p in parts], pa.binary())], names)
    return run


def _added(key: tuple, rows: pa.Table) -> pa.Table:
    total = np.zeros(1 << PART_BITS, np.int64)
    for x in rows.column("_counts").to_pylist():
        total += np.frombuffer(zstandard.decompress(x), "<i8")
    return pa.table({"_part": pa.array([key[0].as_py()], pa.int32()),
                     "_counts": pa.array([zstandard.compress(total.tobytes())], pa.binary())})


def frequencies(counters: DataFrame) -> np.ndarray:
    """How much more often than the rest the shingles of each cell occur; about 0 for rare ones."""
    halfway = counters.groupBy("_part", F.pmod("_task", F.lit(32)).alias("_some")).applyInArrow(_added, "_part int, _counts binary")
    total = np.zeros(1 << CELL_BITS)
    for r in halfway.groupBy("_part").applyInArrow(_added, "_part int, _counts binary").collect():
        total[r["_part"] << PART_BITS: (r["_part"] + 1) << PART_BITS] = np.frombuffer(zstandard.decompress(bytes(r["_counts"])), "<i8")
    usual = float(np.median(total))
    return np.maximum(0, total - usual - 4 * usual**0.5).astype(np.float32)


def prefix(found: np.ndarray, excess: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The first shingles of a set in the common order, and how many matches they call for."""
    n = len(found)
    often = excess[(found >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    level = np.floor(np.log2(1 + often))
    order = np.lexsort((found, level))
    least = -(-percent * n // 100)  # shared by any link
    met = np.cumsum(often[order] + USUAL)
    longest = max(1, int(LENGTHEN * (n - least)))
    choice = [(matches, n - least + matches) for matches in MATCHES if matches <= min(least, longest)]
    cost = [met[length - 1] * (1 + CHECK_COST / matches) + 0.05 * length for matches, length in choice]
    matches, length = choice[int(np.argmin(cost))]
    return found[order[:length]], matches


def map_columns(percent: int) -> list[str]:
    """The columns of a parity map, 64 bits each: unrelated sets of MAP_ROWS shingles differ in more bits than linked ones may."""
    differ = 2 * MAP_ROWS * (100 - percent) / (100 + percent)
    return [f"_p{i}" for i in range(max(2, round(differ / 0.43 / 64)))]


def parity_map(found: np.ndarray, words: int) -> list[int]:
    """64 * words bits, each telling whether an odd number of the set's shingles fall on it.

    Shingles of both sets cancel out, so two maps differ in at most as many
    bits as the sets differ in shingles.
    """
    bits = 64 * words
    odd = np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _may_link(one: str, other: str, percent: int) -> Column:
    """Whether sets with columns of these suffixes can link, by size and parity map; never wrong about a link."""
    n, m = F.col(f"_n{one}"), F.col(f"_n{other}")
    differ = reduce(Column.__add__, [F.bit_count(F.col(p + one).bitwiseXOR(F.col(p + other))) for p in map_columns(percent)])
    return _fits(n, m, percent) & (differ * (100 + percent) <= (n + m) * (100 - percent))


def _prefixes(words: int, percent: int, excess):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, columns = zstandard.ZstdCompressor(3), map_columns(percent)
        for b in few_rows(batches):
            key, size, least, first, body, maps = [], [], [], [], [], []
            texts = b.column("_text")
            for i, found in enumerate(shingles(w, words) for w in split_texts(texts)):
                if len(found):
                    tokens, matches = prefix(found, excess.value, percent)
                    key.append(set_key(found))
                    size.append(len(found))
                    least.append(matches)
                    first.append(tokens.view(np.int64))
                    body.append(pack.compress(texts[i].as_py().encode()))
                    maps.append(parity_map(found, len(columns)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(size, pa.int64()), pa.array(least, pa.int32()),
                 pa.array(first, pa.list_(pa.int64())), pa.array(body, pa.binary()),
                 *[pa.array([m[w] for m in maps], pa.int64()) for w in range(len(columns))]],
                ["_set", "_n", "_matches", "_prefix", "_body", *columns])
    return run


class _Bodies(OrderedDict):
    """Shingle sets of the texts met last."""

    def __init__(self, words: int) -> None:
        super().__init__()
        self.words, self.open = words, zstandard.ZstdDecompressor()

    def of(self, key: int, body: bytes) -> np.ndarray:
        if key in self:
            self.move_to_end(key)
            return self[key]
        data, cuts = raw_bytes(pa.array([self.open.decompress(body).decode()]))
        found = self[key] = shingles(hash_words(data, cuts)[0], self.words)
        if len(self) > 64:
            self.popitem(last=False)
        return found


def _verify(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Bodies(words)
        for b in few_rows(batches):
            keep = []
            for y, x, by, bx in zip(*(b.column(c).to_pylist() for c in ("y", "x", "_by", "_bx"))):
                one, other = held.of(y, by), held.of(x, bx)
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(other) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("x").filter(keep), b.column("y").filter(keep)], ["a", "b"])
    return run


def _fits(one: Column, other: Column, percent: int) -> Column:
    """Whether sets of these sizes can link at all."""
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def linked_sets(classes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root) over sets with any link; ``classes`` is laid out by _set, with _n, _matches, _prefix, _body."""
    tokens = classes.select(F.explode("_prefix").alias("_token"))
    shared = tokens.groupBy("_token").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1").select("_token")
    posts = materialise(classes.select("_set", "_n", "_matches", F.explode("_prefix").alias("_token"))
                        .join(shared, "_token"), "posts")

    def maps(name: str, suffix: str) -> DataFrame:
        return classes.select(F.col("_set").alias(name), *[F.col(c).alias(c + suffix) for c in ("_n", *map_columns(percent))])

    def links(pairs: DataFrame, checked: bool = False) -> DataFrame:
        """The pairs that link.  Sizes and maps rule out most of the others before any text is moved."""
        if not checked:
            pairs = pairs.join(maps("x", "1"), "x").join(maps("y", "2"), "y").where(_may_link("1", "2", percent))
        pairs = materialise(pairs.select("x", "y"), "pairs")
        left = pairs.join(classes.select(F.col("_set").alias("x"), F.col("_body").alias("_bx")), "x")
        right = pairs.select("y").distinct().join(classes.select(F.col("_set").alias("y"), F.col("_body").alias("_by")), "y")
        return materialise(left.join(right, "y").select("x", "y", "_bx", "_by").mapInArrow(
            _verify(words, percent), "a long, b long"), "links")

    hub = [F.min(F.struct(F.xxhash64(F.lit(s), "_set").alias("p"), F.col("_set").alias("y"), F.col("_n").alias("m"), F.col("_matches").alias("l"))).alias(f"h{s}")
           for s in (1, 2)]
    hubs = posts.groupBy("_token").agg(*hub).select("_token", F.explode(F.array("h1", "h2")).alias("h"))
    near = posts.join(hubs, "_token").where((F.col("_set") != F.col("h.y")) & _fits(F.col("_n"), F.col("h.m"), percent))
    met = near.groupBy(F.least("_set", "h.y").alias("x"), F.greatest("_set", "h.y").alias("y")).agg(
        F.count(F.lit(1)).alias("_met"), F.first(F.least("_matches", "h.l")).alias("_least"))
    first = links(met.where("_met >= _least"))
    groups = components(first)

    named = posts.join(groups.withColumnRenamed("node", "_set"), "_set", "left").withColumn("_root", F.coalesce("root", "_set"))
    mixed = named.groupBy("_token").agg(F.min("_root").alias("lo"), F.max("_root").alias("hi")).where("lo <> hi").select("_token")
    # a set alone in a list against every other, two sets of one component never
    kept = ("_set", "_n", "_matches", "_root", *map_columns(percent))
    apart = materialise(named.join(mixed, "_token").select("_token", "_set", "_matches", "_root").join(
        maps("_set", ""), "_set").select("_token", *kept), "apart")
    one, other = (apart.select("_token", *[F.col(c).alias(c + s) for c in kept]) for s in "12")
    meets = one.join(other, "_token").where(
        (F.col("_set1") < F.col("_set2")) & (F.col("_root1") != F.col("_root2")) & _may_link("1", "2", percent))
    pairs = meets.groupBy("_set1", "_set2").agg(
        F.count(F.lit(1)).alias("_met"), F.first(F.least("_matches1", "_matches2")).alias("_least")).where("_met >= _least")
    second = links(pairs.select(F.col("_set1").alias("x"), F.col("_set2").alias("y")), checked=True)
    return joined_components(groups, second)


def with_component(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, n_shingles, component_id (the smallest ``key`` it is linked to, itself included)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    passed = materialise(rows.mapInArrow(
        _sets(words), "_id long, _n long, _set long, _part int, _task int, _counts binary"), "sets")
    sets = passed.where("_part is null").select("_id", "_n", "_set")
    excess = spark.sparkContext.broadcast(frequencies(passed.where("_part is not null").select("_part", "_task", "_counts")))
    distinct = rows.select("_text").mapInArrow(
        _prefixes(words, percent, excess),
        "_set long, _n long, _matches int, _prefix array<long>, _body binary, " + ", ".join(f"{p} long" for p in map_columns(percent))
    ).groupBy("_set").agg(*[F.first(c).alias(c) for c in ("_n", "_matches", "_prefix", "_body", *map_columns(percent))])
    # laid out by set, so that texts join candidates where they lie
    path = scratch_path(spark, "text-sets")
    name = table_name(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct.write.bucketBy(buckets, "_set").option("path", path).saveAsTable(name)
    groups = linked_sets(spark.table(name), words, percent)
    lowest = sets.where("_set is not null").groupBy("_set").agg(F.min("_id").alias("_low"))
    rooted = lowest.join(groups.withColumnRenamed("node", "_set"), "_set", "left").select(
        "_set", "_low", F.coalesce("root", "_set").alias("_root"))
    named = rooted.join(rooted.groupBy("_root").agg(F.min("_low").alias("component_id")), "_root").select("_set", "component_id")
    return sets.join(named, "_set", "left").select(
        F.col("_id").alias(key), F.col("_n").alias("n_shingles"), F.coalesce("component_id", "_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents of ``docs`` that are the first of their component, once each, columns as they were.

    The first is the one with the smallest id, a null id last; of rows that
    are equal in all columns one stays.  Rows without words are all kept.
    Rows are known by a hash of all their columns, so an id may stand on
    different texts.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_doc")).select("_doc", F.xxhash64("_doc").alias("_row"))
    found = with_component(rows.select("_row", F.col("_doc.text").alias("text")), words, percent, key="_row")
    classes = found.where("n_shingles > 0").groupBy("_row").agg(
        F.count(F.lit(1)).alias("_n"), F.first("component_id").alias("_class"))
    order = F.struct(F.col("_id").isNull(), "_id", "_row", "_n")
    # written, as it is joined twice and its plan is the longest of all
    first = materialise(classes.join(rows.select("_row", F.col("_doc.doc_id").alias("_id")), "_row")
                        .groupBy("_class").agg(F.min(order).alias("_first")).select("_first._row", "_first._n"), "first")
    wordless = F.coalesce(F.regexp_count("_doc.text", F.lit(WORD)), F.lit(0)) == 0
    kept = rows.where(~wordless).join(first, "_row")
    once = kept.where("_n = 1").select("_doc")
    several = kept.where("_n > 1").groupBy("_row").agg(F.first("_doc").alias("_doc")).select("_doc")
    return once.union(several).union(rows.where(wordless).select("_doc")).select("_doc.*")
