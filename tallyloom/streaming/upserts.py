"""One current row per key, at the cost of what a batch changes.

Rows lie in buckets by the hash of their key.  A batch rewrites only the
buckets that its keys fall into; the others keep their files.  Which folder
holds each bucket stands in a small manifest, written beside the data and put
in place by a rename, so a reader sees the table before or after a batch and
never in between.  The manifest also holds the number of the batch it came
from, so a batch that is run again after a failure is found to be done.

The files of the manifest before the current one stay until the next batch,
for readers that have begun.  The last of several rows of a key in a batch is
any of them; null keys are keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.streaming.runner import finish
from tallyloom.workspace import scratch_path

BUCKETS = 16


class Manifest(NamedTuple):
    version: int
    batch: int
    folders: dict[str, str]  # bucket -> folder under the table


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    system, folder = _folder(spark, path)
    return [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []


def _delete(spark: SparkSession, path: str) -> None:
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def _versions(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in _names(spark, f"{path}/manifests") if n.startswith("v"))


def _read(spark: SparkSession, path: str, name: str) -> Manifest:
    system, file = _folder(spark, f"{path}/manifests/{name}")
    stream = system.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    return Manifest(int(name[1:]), found["batch"], found["folders"])


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The current state of the table, or None before its first batch."""
    versions = _versions(spark, path)
    return _read(spark, path, versions[-1]) if versions else None


def _put(spark: SparkSession, path: str, new: Manifest) -> None:
    """Writes a manifest under a name of its own, then renames it into its place."""
    waiting = f"{path}/manifests/_{uuid.uuid4().hex}"
    system, file = _folder(spark, waiting)
    stream = system.create(file)
    try:
        stream.write(bytearray(json.dumps({"batch": new.batch, "folders": new.folders}).encode()))
    finally:
        stream.close()
    if not system.rename(file, _folder(spark, f"{path}/manifests/v{new.version:012d}")[1]):
        raise RuntimeError(f"another writer has changed {path}")


def _clear(spark: SparkSession, path: str, kept: Sequence[Manifest]) -> None:
    """Removes older manifests, and data that neither of the ``kept`` ones names."""
    names = {f"v{m.version:012d}" for m in kept}
    for name in _names(spark, f"{path}/manifests"):
        if name not in names:
            _delete(spark, f"{path}/manifests/{name}")
    held = {f for m in kept for f in m.folders.values()}
    used = {f.split("/")[0] for f in held}
    for name in _names(spark, f"{path}/data"):
        if name not in used:
            _delete(spark, f"{path}/data/{name}")
            continue
        for bucket in _names(spark, f"{path}/data/{name}"):
            if bucket.startswith("_bucket=") and f"{name}/{bucket}" not in held:
                _delete(spark, f"{path}/data/{name}/{bucket}")


def upsert_batch(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Merges one batch into the table at ``path``; a batch that the table already has changes nothing."""
    spark = batch.sparkSession
    before = manifest(spark, path)
    if before is not None and before.batch >= batch_id:
        return
    values = [c for c in batch.columns if c not in keys]
    name = f"{batch_id:012d}-{uuid.uuid4().hex[:8]}"
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket")
    new = batch.select("*", bucket, F.lit(1).alias("_new")).persist()
    try:
        touched = [f"_bucket={r[0]}" for r in new.select("_bucket").distinct().collect()]  # no more than there are buckets
        folders = dict(before.folders) if before else {}
        held = [f"{path}/data/{folders[b]}" for b in touched if b in folders]
        both = new
        if held:
            both = spark.read.schema(batch.schema).parquet(*held).select("*", bucket, F.lit(0).alias("_new")).unionByName(new)
        merged = both.repartition(F.col("_bucket")).groupBy("_bucket", *keys).agg(
            F.max_by(F.struct(F.lit(0), *values), "_new").alias("_row"))
        if touched:
            merged.select("_bucket", *keys, *[F.col("_row").getField(c).alias(c) for c in values]).write.partitionBy(
                "_bucket").parquet(f"{path}/data/{name}")
            folders |= {b: f"{name}/{b}" for b in touched}
    finally:
        new.unpersist()
    after = Manifest(before.version + 1 if before else 1, batch_id, folders)
    _put(spark, path, after)
    _clear(spark, path, [m for m in (before, after) if m])


def start_upsert(stream: DataFrame, path: str, keys: Sequence[str], every: str | None = None,
                 checkpoint: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep one current row per key of an update-mode stream at ``path``.

    ``buckets`` is the share of the table that a changed key rewrites; it is
    fixed for the life of the table.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, path, keys, buckets)

    writer = stream.writeStream.outputMode("update").option(
        "checkpointLocation", checkpoint or scratch_path(stream.sparkSession, "checkpoint"))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.foreachBatch(land).start()


def read_upserted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as of now; later batches do not show in it."""
    now = manifest(spark, path)
    if now is None or not now.folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{f}" for f in sorted(now.folders.values())])


def run_upsert(stream: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Run an update-mode stream over what is there into a table with one current row per key."""
    path = scratch_path(stream.sparkSession, "upserts")
    finish(start_upsert(stream, path, keys, buckets=buckets))
    return read_upserted(stream.sparkSession, path, stream.schema)
