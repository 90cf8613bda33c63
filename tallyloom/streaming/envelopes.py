"""Message envelopes and payload decoding; the same transforms serve batch and stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.fixed_values import KAFKA_ENVELOPE


def kafka_source(spark: SparkSession, servers: str, topics: Sequence[str],
                 starting: str = "earliest", min_partitions: int | None = None,
                 fail_on_data_loss: bool = True) -> DataFrame:
    """A Kafka stream; needs the Spark Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics)).option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def as_kafka(df: DataFrame, key: Column, value: Column, topic: Column, offset: Column,
             timestamp: Column) -> DataFrame:
    """Rows in the fixed Kafka envelope."""
    parts = [key.cast("binary"), value.cast("binary"), topic, F.lit(0), offset, timestamp, F.lit(0)]
    return df.select(*[
        c.cast(f.dataType).alias(f.name) for c, f in zip(parts, KAFKA_ENVELOPE.fields)])


def value_text(envelope: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Envelopes with the payload as text; rows without a payload are dropped unless ``keep_empty``."""
    rows = envelope if keep_empty else envelope.filter(F.col("value").isNotNull())
    return rows.withColumn("value", F.col("value").cast("string"))


def json_paths(envelope: DataFrame, paths: Mapping[str, str], *keep: str) -> DataFrame:
    text = F.col("value").cast("string")
    return envelope.select(
        *keep, *[F.get_json_object(text, path).alias(name) for name, path in paths.items()])


def json_record(envelope: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """Payload columns by schema; a malformed payload gives nulls."""
    record = F.from_json(F.col("value").cast("string"), schema)
    return envelope.select(*keep, record.alias("_record")).select(*keep, "_record.*")


def payload_words(records: DataFrame, data: str = "data") -> DataFrame:
    """Binary payloads as lower-case words."""
    return records.select(F.lower(F.col(data).cast("string")).alias("word"))
