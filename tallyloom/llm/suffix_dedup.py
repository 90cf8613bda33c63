"""Removal of repeated passages: a distributed merge sort of suffixes.

Every byte that lies in a string of 200 bytes which starts anywhere else too
goes.  Each distinct text is kept once, in blocks of a few megabytes.  A block
sorts the suffixes of its anchors (see ``front_coding``), cuts the sorted run
by the anchors' hashes into pages and sends each page front-coded.  A part
merges the pages of all blocks by a loser tree that carries common prefixes
along and never compares a byte it knows.  Neighbours in the merged order give
the repeated windows, and these go back to their blocks.  Before that, anchors
whose gram stands nowhere else are left out, as none of their windows repeats;
hashes decide nothing else.

Defined results: a null text is empty; equal rows are equal texts, so each is
removed whole from 200 bytes on; texts of fewer bytes stay; an empty table
gives no rows; bytes removed may leave part of a character, so what is kept is
binary; other columns are not read.

Bounds: a block holds ``BLOCK`` bytes of texts (one longer text is a block's
share of its own), a part about ``PART`` bytes of suffixes.  A gram of 64 bytes
that is an anchor in very many distinct texts is in one part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.front_coding import WINDOW, Anchors, anchors, opened, page, repeated_windows, sorted_run
from tallyloom.workspace import materialise, scratch_path, table_name

BLOCK = 4 << 20
PART = 8 << 20
SUFFIX = 270  # bytes of an anchor's suffix and of what stands before it, on average
SEEN = 200_000  # digests a task remembers


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text once per task, compressed, and how often else the task has met it."""
    names = ["_digest", "_body", "_n"]
    seen: dict[bytes, int] = {}

    def rest() -> pa.RecordBatch:
        more = {k: n for k, n in seen.items() if n}
        return pa.RecordBatch.from_arrays([pa.array(list(more), pa.binary()), pa.nulls(len(more), pa.binary()),
                                           pa.array(list(more.values()), pa.int64())], names)

    pack = zstandard.ZstdCompressor(3).compress
    for b in batches:
        for begin in range(0, b.num_rows, 256):
            part = b.slice(begin, 256)
            keys, bodies = [], []
            for key, body in zip(part.column("_digest").to_pylist(), part.column("_text").cast(pa.binary()).to_pylist()):
                if key in seen:
                    seen[key] += 1
                else:
                    seen[key] = 0
                    keys.append(key)
                    bodies.append(pack(body))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(bodies, pa.binary()), pa.array([1] * len(keys), pa.int64())], names)
            if len(seen) > SEEN:
                yield rest()
                seen.clear()
    yield rest()


class _Block:
    """The texts of a block in order of their digests, one after the other."""

    def __init__(self, table: pa.Table) -> None:
        self.table = table.sort_by("_digest")
        unpack = zstandard.ZstdDecompressor().decompress
        bodies = [unpack(x) for x in self.table.column("_body").to_pylist()]
        self.data = np.frombuffer(b"".join(bodies), np.uint8)
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes

    def anchors(self) -> Anchors:
        return anchors(self.data, self.ends)


def _classes(table: pa.Table) -> pa.Table:
    """The block's anchors by the hash of their gram."""
    grams, n = np.unique(_Block(table).anchors().gram, return_counts=True)
    block = table.column("_block")[0].as_py()
    return pa.table({"_block": pa.array([block] * len(grams), pa.int64()), "_gram": grams.view(np.int64), "_n": n})


def _pages(parts: int):
    def run(texts: pa.Table, live: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes]] = []
        if texts.num_rows and live.num_rows:
            block = _Block(texts)
            found = block.anchors()
            mine = np.isin(found.gram, live.column("_gram").to_numpy().view(np.uint64))
            found = Anchors(*(x[mine] for x in found))
            text = np.searchsorted(block.ends, found.at, side="right")
            run = sorted_run(block.data, block.begins, text, found)
            part = np.array([int.from_bytes(s[:4], "big") * parts >> 32 for s in run.suffixes], np.int64)
            cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)).tolist()
            name = texts.column("_block")[0].as_py()
            rows = [(int(part[a]), name, page(run, a, b)) for a, b in zip(cuts, cuts[1:])]
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                        ["_part", "_block", "_page"])
    return run


def _repeats(pages: pa.Table) -> pa.Table:
    """Byte ranges of repeated windows: _block, _text (its number there), _from, _to."""
    runs = [opened(x) for x in pages.column("_page").to_pylist()]
    found = repeated_windows(runs)
    blocks = np.array(pages.column("_block").to_pylist(), np.int64)
    text = np.array([runs[r].text[i] for r, i in found[:, :2].tolist()], np.int64)
    at = np.array([runs[r].at[i] for r, i in found[:, :2].tolist()], np.int64)
    return pa.table({"_block": blocks[found[:, 0]], "_text": text, "_from": at - found[:, 3], "_to": at - found[:, 2] + WINDOW})


def _cut(bodies: bool):
    def run(texts: pa.Table, ranges: pa.Table) -> pa.Table:
        rows = []
        if texts.num_rows:
            block = _Block(texts)
            depth = np.zeros(len(block.data) + 1, np.int32)
            start = block.begins[ranges.column("_text").to_numpy()] if ranges.num_rows else np.zeros(0, np.int64)
            np.add.at(depth, start + ranges.column("_from").to_numpy(), 1)
            np.add.at(depth, start + ranges.column("_to").to_numpy(), -1)
            gone = np.cumsum(depth, out=depth)[:-1] > 0
            for key, n, begin, end in zip(block.table.column("_digest").to_pylist(), block.table.column("_n").to_pylist(),
                                          block.begins.tolist(), block.ends.tolist()):
                own = gone[begin:end] if n < 2 or end - begin < WINDOW else np.ones(end - begin, bool)
                edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
                kept = block.data[begin:end][~own].tobytes()
                rows.append((key, end - begin, int(own.sum()), [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])],
                             hashlib.sha256(kept).hexdigest(), *([kept] if bodies else [])))
        names = _RESULT.names[: 6 if bodies else 5]
        return pa.table([pa.array([r[i] for r in rows], _RESULT.field(c).type) for i, c in enumerate(names)], names)
    return run


_RESULT = pa.schema([("_digest", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _digest(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def distinct_cut(docs: DataFrame, text: str = "text", bodies: bool = False) -> DataFrame:
    """One row per distinct text: _digest (SHA-256), n_bytes, n_removed, spans (start, end), kept_sha256 and with ``bodies`` kept."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(content))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK))
    packed = docs.select(_digest(content).alias("_digest"), content.alias("_text")).mapInArrow(
        _packed, "_digest binary, _body binary, _n long").withColumn(
        "_block", F.pmod(F.xxhash64("_digest"), F.lit(blocks)))
    # laid out by block: the texts move once and are then read where they lie
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "text-blocks")
    packed.repartition(buckets, "_block").groupBy("_block", "_digest").agg(
        F.first("_body", ignorenulls=True).alias("_body"), F.sum("_n").alias("_n")).write.bucketBy(
        buckets, "_block").option("path", path).option("compression", "uncompressed").saveAsTable(table_name(path))
    texts = spark.table(table_name(path))

    classes = texts.groupBy("_block").applyInArrow(_classes, "_block long, _gram long, _n long")
    live = materialise(classes.withColumn("_all", F.sum("_n").over(W.partitionBy("_gram"))).where("_all > 1").select(
        "_block", "_gram", "_n"), "live")
    suffixes = live.agg(F.sum("_n")).first()[0] or 0
    parts = max(1, math.ceil(suffixes * SUFFIX / PART))
    by_block = texts.groupBy("_block")
    pages = by_block.cogroup(live.select("_block", "_gram").groupBy("_block")).applyInArrow(
        _pages(parts), "_part long, _block long, _page binary")
    ranges = pages.repartition(parts, "_part").groupBy("_part").applyInArrow(_repeats, "_block long, _text long, _from long, _to long")
    schema = "_digest binary, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept_sha256 string"
    return texts.groupBy("_block").cogroup(ranges.groupBy("_block")).applyInArrow(
        _cut(bodies), schema + (", kept binary" if bodies else ""))


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_removed, spans, kept_sha256 and kept (the remaining bytes) of ``text``."""
    cut = distinct_cut(docs, text, bodies=True)
    names = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "spans", "kept_sha256", "kept")]
    rows = docs.select(F.struct(*names).alias("_doc"), _digest(F.coalesce(F.col(text), F.lit(""))).alias("_digest"))
    return rows.join(cut, "_digest").drop("_digest").select("_doc.*", "n_bytes", "n_removed", "spans", "kept_sha256", "kept")


def repeat_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    cut = distinct_cut(docs).select("_digest", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
    rows = docs.select("doc_id", _digest(F.coalesce(F.col("text"), F.lit(""))).alias("_digest"))
    return rows.join(materialise(cut, "cut-texts"), "_digest").drop("_digest")
