"""Shards of near equal bytes by histogram sort.

Rows are ordered by a 63-bit key: 32 bits of a group hash, so equal texts lie
side by side, then 31 bits that tell rows apart, so that even a group of a
third of all rows can be cut.  Splitters are found without a sort: each round
counts the exact bytes below evenly spaced candidate keys inside every open
interval, then narrows each interval to the candidate gap that holds its
target.  Only those sums reach the driver.  Rows move once, into slices that
are cut finely enough for one task.

Defined results: a null text has size 16 and checksum 0; an empty table gives
no rows; equal rows are told apart by their place in the written table, and
may lie on either side of a cut; other columns are carried along, save that
``shard`` and ``slot`` are replaced.  Two cuts
may coincide where one row is larger than a shard, which leaves a shard empty.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.workspace import materialise

KEY_BITS = 63
MAP_BITS = 12
PROBES = 1 << 16  # sums that one round may send to the driver


def sort_key(group: Column, row: Column) -> Column:
    """63 bits: a 32-bit group number above 31 bits of a row's hash."""
    return F.shiftleft(group, 31).bitwiseOR(F.xxhash64(row).bitwiseAND(F.lit((1 << 31) - 1)))


def splitters(keyed: DataFrame, targets: list[tuple[int, int]], total: int) -> list[int]:
    """For each (bytes wanted below, tolerance) the key below which so many bytes lie.

    ``keyed`` has ``_key`` and ``_size``.  A cut is taken as soon as a
    candidate is within its tolerance, else when its interval is one key wide.
    """
    cuts: list[int | None] = [None] * len(targets)
    open_at = {0: (0, range(len(targets)))}  # interval number -> bytes below it, its targets
    width = KEY_BITS
    while open_at:
        bits = min(width, max(1, int(math.log2(PROBES // len(open_at)))))
        inner = width - bits
        part = keyed if width == KEY_BITS else keyed.join(
            F.broadcast(keyed.sparkSession.createDataFrame([(i,) for i in open_at], "_in long")),
            F.shiftright("_key", width) == F.col("_in"), "left_semi")
        sums: dict[int, list[tuple[int, int]]] = {}
        for probe, size in part.groupBy(F.shiftright("_key", inner)).agg(F.sum("_size")).collect():
            sums.setdefault(probe >> bits, []).append((probe, size))
        following: dict[int, tuple[int, list[int]]] = {}
        for interval, (below, wanted) in open_at.items():
            found = sorted(sums.get(interval, []))
            # a probe stands for the keys from its own begin on; bytes below it come from those before
            keys = [p for p, _ in found] + [(found[-1][0] if found else interval << bits) + 1]
            sizes = list(accumulate((s for _, s in found), initial=below))
            for t in wanted:
                goal, slack = targets[t]
                right = min(bisect_left(sizes, goal), len(sizes) - 1)
                best = min((right, max(0, right - 1)), key=lambda i: abs(sizes[i] - goal))
                if abs(sizes[best] - goal) <= slack or inner == 0:
                    cuts[t] = keys[best] << inner
                else:  # the goal lies inside the gap that ends at ``right``
                    gap = keys[right - 1]
                    following.setdefault(gap, (sizes[right - 1], []))[1].append(t)
        open_at, width = following, inner
    return sorted(cuts)


def slice_of(spark, cuts: list[int], key: str) -> tuple[DataFrame, Column]:
    """A table of at most 2**MAP_BITS rows by leading key bits, and the slice number of a row joined to it."""
    shift = KEY_BITS - MAP_BITS
    rows = []
    for lead in range(1 << MAP_BITS):
        low, high = bisect_right(cuts, lead << shift), bisect_left(cuts, (lead + 1) << shift)
        rows.append((lead, low, cuts[low:high]))
    lookup = spark.createDataFrame(rows, "_lead int, _base int, _cuts array<long>")
    return lookup, F.col("_base") + F.size(F.filter("_cuts", lambda c: c <= F.col(key)))


def histogram_shards(df: DataFrame, size: Column, group: Column, shards: int = 40,
                     tolerance: float = 0.002, slice_rows: int = 1_000_000) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``size`` is a row's bytes (long), ``group`` a number below 2**32 by which
    rows keep together.  Each cut misses its place by at most ``tolerance``
    shards unless one row is larger.  ``slice_rows`` is what one task sorts.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c not in ("shard", "slot")]
    kept = materialise(
        df.select(F.struct(*names).alias("_doc"), size.alias("_size"), group.cast("long").alias("_group"),
                  F.monotonically_increasing_id().alias("_row"))
        .select("_doc", "_size", sort_key(F.col("_group"), F.col("_row")).alias("_key")), "keyed")
    keyed = kept.select("_key", "_size")
    total, rows = keyed.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, math.ceil(rows / shards / slice_rows))
    mean = total / (shards * parts)
    targets = [(total * i // (shards * parts),
                int(tolerance * parts * mean) if i % parts == 0 else int(mean / 4))
               for i in range(1, shards * parts)]
    cuts = splitters(keyed, targets, total) if total else [0] * len(targets)
    lookup, number = slice_of(spark, cuts, "_key")
    placed = kept.withColumn("_lead", F.shiftright("_key", KEY_BITS - MAP_BITS).cast("int")).join(
        F.broadcast(lookup), "_lead").withColumn("_slice", number)
    sizes = dict(placed.groupBy("_slice").count().collect())
    starts, before = [], 0
    for s in range(shards * parts):
        before = 0 if s % parts == 0 else before
        starts.append((s, s // parts, before))
        before += sizes.get(s, 0)
    offsets = spark.createDataFrame(starts, "_slice int, shard int, _start long")
    order = W.partitionBy("_slice").orderBy("_key")
    return (placed.withColumn("_place", F.row_number().over(order)).join(F.broadcast(offsets), "_slice")
            .select(*[F.col("_doc").getField(c).alias(c) for c in names], "shard", (F.col("_start") + F.col("_place") - 1).alias("slot")))


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    narrow = docs.select(
        "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    placed = histogram_shards(narrow, F.col("size"), F.col("text_crc32"), shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
