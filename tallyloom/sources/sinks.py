"""Writers and table layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def save_partitioned(df: DataFrame, table: str, path: str, by: Sequence[str]) -> DataFrame:
    """Overwrite an external Parquet table partitioned by ``by``.

    The rebalance hint gathers each partition value, so that rare values do not
    leave one file per task, and lets adaptive execution split a value that
    holds most rows over many tasks.
    """
    (df.hint("rebalance", *[F.col(c) for c in by]).write.format("parquet").mode("overwrite")
     .partitionBy(*by).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def create_table_as(df: DataFrame, table: str, path: str, by: Sequence[str] = ()) -> DataFrame:
    spark = df.sparkSession
    view = f"{table}_rows"
    df.createOrReplaceTempView(view)
    layout = f"PARTITIONED BY ({', '.join(by)})" if by else ""
    spread = f"/*+ REBALANCE({', '.join(by)}) */" if by else ""
    spark.sql(f"CREATE TABLE {table} USING PARQUET {layout} LOCATION '{path}' "
              f"AS SELECT {spread} * FROM {view}")
    spark.catalog.dropTempView(view)
    return spark.table(table)


def replace_table(df: DataFrame, table: str, path: str) -> DataFrame:
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    return create_table_as(df, table, path)


def save_clustered(df: DataFrame, table: str, path: str, key: str, tie: str) -> DataFrame:
    """Table whose files hold neighbouring keys in order.

    Range partitioning on (key, tie) keeps a key in adjacent files and gives a
    very frequent key several files instead of one huge one.
    """
    ordered = df.repartitionByRange(key, tie).sortWithinPartitions(key, tie)
    ordered.write.format("parquet").mode("overwrite").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def save_bucketed(df: DataFrame, table: str, path: str, key: str, sort: str,
                  buckets: int = 40) -> DataFrame:
    """Bucketed and sorted table; joins on ``key`` then need no shuffle.

    Rows are gathered per bucket before the write; a bucket that holds most
    rows is split over several tasks, each adding a file to it.
    """
    (df.hint("rebalance", buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(sort)
     .format("parquet").mode("overwrite").option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def save_capped(df: DataFrame, path: str, max_rows: int) -> DataFrame:
    """Parquet files of at most ``max_rows`` rows."""
    df.write.option("maxRecordsPerFile", max_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_single_rows(lines: DataFrame, path: str, files_per_task: int = 200) -> str:
    """Text files of one row each, made by as many tasks as their number calls for.

    Opening a file costs far more than a row, so a small table read by one task
    would be written by that task alone.  Tasks put their own files in place;
    the driver does not move them one after another.
    """
    tasks = max(1, -(-lines.count() // files_per_task))
    lines.repartition(tasks).write.options(**{
        "maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}).text(path)
    return path


def save_csv(df: DataFrame, path: str, by: Sequence[str] = (), null_value: str = "NA",
             **options: str) -> str:
    writer = df.write.options(header=True, nullValue=null_value, **options)
    (writer.partitionBy(*by) if by else writer).csv(path)
    return path


def json_documents(placed: DataFrame, record: Column, position: str, size: int) -> DataFrame:
    """JSON arrays of ``size`` records each, by position: (``chunk``, ``document``)."""
    return placed.groupBy(F.floor((F.col(position) - 1) / size).alias("chunk")).agg(
        F.to_json(F.collect_list(record)).alias("document"))


def attach_partitions(spark: SparkSession, table: str, path: str, columns: str,
                      by: str, first: Mapping[str, str] | None = None) -> DataFrame:
    """External table over existing partition folders: add one, then find the rest."""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet "
              f"PARTITIONED BY ({by}) LOCATION '{path}'")
    for value, folder in (first or {}).items():
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({by}='{value}') "
                  f"LOCATION '{folder}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def analyze_columns(spark: SparkSession, table: str) -> None:
    """Column statistics, for the optimiser's join choice."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def bounded_partitions(df: DataFrame, size: Column, bytes_per_partition: int) -> DataFrame:
    """Even partitions of about ``bytes_per_partition`` bytes by the rows' ``size``, for work with a memory bound."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return df.repartition(max(1, -(-int(total) // bytes_per_partition)))


def rows_per_file(df: DataFrame) -> DataFrame:
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values, lowest and highest.

    Each column is read on its own and its equal values are counted first, so
    a row is never repeated once per column.
    """
    def one(name: str, kind: str) -> DataFrame:
        counted = df.select(F.col(f"`{name}`").alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        return counted.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("v").alias("distinct_values"), F.min("v").cast("string").alias("lowest"),
            F.max("v").cast("string").alias("highest"),
        ).select(F.lit(name).alias("column_name"), F.lit(kind).alias("type"), "rows", "nulls",
                 "distinct_values", "lowest", "highest")

    return reduce(DataFrame.unionByName, [one(name, kind) for name, kind in df.dtypes])
