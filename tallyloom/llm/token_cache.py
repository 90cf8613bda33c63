"""Token counts of whole texts through a digest cache.

A text is looked up in a stored table by the SHA-256 of its content and a
digest of the tokenizer (its file and library version).  Only texts with no
stored count are encoded, each distinct one once, and their counts are
appended to the table.  Copies never reach a task twice: equal texts meet in
a partial aggregate before they are moved.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens;
equal rows give equal rows; an empty table gives no rows and stores none;
other columns are not read.  Two runs that append the same text at once store
it twice, which readers merge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.vocabularies import piece_counter, runs
from tallyloom.workspace import scratch_path

SCHEMA = "digest binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Changes with the model file and with the library that reads it."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + version("sentencepiece").encode()).hexdigest()


def stored(spark: SparkSession, cache: str) -> DataFrame | None:
    """The cache table, or None before the first append."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(SCHEMA).parquet(cache) if found else None


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(path)
        for b in batches:
            counts = [n for part in runs(b.column("_text").to_pylist()) for n in counter.counts(part)]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, model: str, cache: str, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes and n_tokens of ``text``; ``cache`` is the folder of the stored counts.

    ``model`` is the place of a sentencepiece model that every executor has.
    The row carries only the digest to the cache, not the text, so select the
    columns to keep before the call.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer_digest(model)
    content = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(content, 256))
    wanted = docs.select(digest.alias("digest"), content.alias("_text")).groupBy("digest").agg(F.first("_text").alias("_text"))
    before = stored(spark, cache)
    if before is not None:
        wanted = wanted.join(before.where(F.col("tokenizer") == tokenizer).select("digest"), "digest", "left_anti")
    wanted.mapInArrow(_encode(model), "digest binary, n_tokens long").select(
        "digest", F.lit(tokenizer).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = stored(spark, cache).where(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("_tokens"))
    kept = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens")]
    narrow = docs.select(F.struct(*kept).alias("_doc"), digest.alias("digest"),
                         F.octet_length(content).cast("long").alias("_bytes"))
    return narrow.join(counts, "digest").select("_doc.*", F.col("_bytes").alias("n_bytes"), F.col("_tokens").alias("n_tokens"))


def document_tokens(docs: DataFrame, model: str, limit: int = 4096, cache: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.  Without ``cache`` a new one is made."""
    counted = count_tokens(docs.select("doc_id", "text"), model, cache or scratch_path(docs.sparkSession, "token-counts"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
