"""Starting streams and landing their results in tables.

Results of complete and update mode go through ``foreachBatch`` into one current
folder, written by the executors, so no result gathers on the driver and none
but the last stays.  A batch that is run again after a failure gives the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.workspace import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """A folder (or path pattern) as a stream; streams always need their schema stated."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def finish(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query; its failure is raised here."""
    try:
        query.awaitTermination()
    finally:
        query.stop()


def _start(stream: DataFrame, mode: str, checkpoint: str, every: str | None):
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_memory(stream: DataFrame, name: str, mode: str = "complete",
                 every: str | None = None) -> StreamingQuery:
    """In-memory table for looking at a small result while a stream runs."""
    checkpoint = scratch_path(stream.sparkSession, "checkpoint")
    return _start(stream, mode, checkpoint, every).format("memory").queryName(name).start()


def start_files(stream: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet",
                every: str | None = None, checkpoint: str | None = None,
                files_per_value: int = 4, spread_by: Sequence[str] = ()) -> StreamingQuery:
    """Append rows to (partitioned) files.

    Rows of a partition value are gathered before the write, so a batch leaves
    at most ``files_per_value`` files per value; a value that holds most rows
    is written by that many tasks.  ``spread_by`` names columns that tell rows
    apart; without it equal rows go to one task.
    """
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "checkpoint")
    if by:
        others = list(spread_by) or [c for c in stream.columns if c not in by] or list(by)
        share = F.pmod(F.xxhash64(*others), F.lit(files_per_value))
        stream = stream.repartition(*[F.col(c) for c in by], share)
    writer = _start(stream, "append", checkpoint, every).format(fmt)
    return (writer.partitionBy(*by) if by else writer).start(path)


def start_topic(stream: DataFrame, servers: str, topic: str, mode: str = "update",
                every: str | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Key and value text rows to a Kafka topic; needs the Spark Kafka connector."""
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "checkpoint")
    return (_start(stream, mode, checkpoint, every).format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic).start())


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, by the file system the path belongs to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def current(spark: SparkSession, path: str) -> str | None:
    """The folder that holds a stream's current result: the finished one of the last batch."""
    done = [n for n in _children(spark, path) if n.startswith("batch=") and "_SUCCESS" in _children(spark, f"{path}/{n}")]
    return max(done, key=lambda n: (int(n.split("=")[1].split("-")[0]), n.split("-")[1])) if done else None


def start_current(stream: DataFrame, path: str, mode: str, keys: Sequence[str] = (), every: str | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Keep one current result under ``path``: the whole of it in complete mode, one row per key in update mode.

    A batch is written next to the result before it, merged with it where
    there are ``keys``, and only then is the older one removed.  A batch that
    is run again merges into what it finds and gives the same rows.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "checkpoint")

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = current(session, path)
        if keys and before:
            values = [c for c in batch.columns if c not in keys]
            held = session.read.schema(batch.schema).parquet(f"{path}/{before}")
            both = held.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
            batch = both.groupBy(*keys).agg(F.max_by(F.struct(*values), "_new").alias("_row")).select(*keys, "_row.*")
        batch.write.parquet(f"{path}/batch={batch_id:012d}-{len(_children(session, path)):04d}{uuid.uuid4().hex[:8]}")
        kept = current(session, path)
        for name in _children(session, path):
            if name != kept:
                _remove(session, f"{path}/{name}")

    return _start(stream, mode, checkpoint, every).foreachBatch(land).start()


def run_to_files(stream: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Run an append stream over what is there and read its files back."""
    spark = stream.sparkSession
    path = scratch_path(spark, "stream_files")
    finish(start_files(stream, path, by))
    return spark.read.schema(stream.schema).parquet(path)


def _run_current(stream: DataFrame, mode: str, keys: Sequence[str]) -> DataFrame:
    spark = stream.sparkSession
    path = scratch_path(spark, f"stream_{mode}")
    finish(start_current(stream, path, mode, keys))
    found = current(spark, path)
    if found is None:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{path}/{found}").select(*stream.columns)


def run_complete(stream: DataFrame) -> DataFrame:
    """Run a complete-mode aggregate over what is there; only its last result is kept."""
    return _run_current(stream, "complete", ())


def run_upsert(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Run an update-mode aggregate into a table with one current row per key."""
    return _run_current(stream, "update", keys)
