"""Readers for files of every shape the jobs take in."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             null_value: str = "NA", **options: str) -> DataFrame:
    """Headed CSV, blanks trimmed, ``null_value`` as null.

    Without a schema the types are inferred, which reads the whole input once more.
    """
    reader = spark.read.options(
        header=True, nullValue=null_value,
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, **options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_positional(spark: SparkSession, path: str, columns: Mapping[str, str],
                    sep: str = " ") -> DataFrame:
    """Headerless delimited text; columns are named by position and cast, bad values null."""
    raw = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(columns))])
    rows = spark.read.schema(raw).option("sep", sep).csv(path)
    return rows.select(*[
        F.col(f"_c{i}").try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(columns.items())])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def rewrite_splittable(spark: SparkSession, source: str, target: str,
                       partitions: int | None = None) -> DataFrame:
    """Copy compressed text, one task per file, to plain files many tasks can read.

    Without a number of partitions their size follows the session's advisory size.
    """
    lines = read_lines(spark, source)
    spread = lines.repartition(partitions) if partitions else lines.hint("rebalance")
    spread.write.option("lineSep", "\n").text(target)
    return read_lines(spark, target)


def read_path_sql(spark: SparkSession, path: str) -> DataFrame:
    return spark.sql("SELECT * FROM parquet.`" + path.replace("`", "``") + "`")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str,
                    renames: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.schema(schema).json(path).withColumnsRenamed(dict(renames or {}))


def read_json_documents(spark: SparkSession, path: str,
                        schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_labelled_files(spark: SparkSession, folders: Mapping[str, str],
                        pattern: str = "*") -> DataFrame:
    """Binary files of several folders, each row with its folder's label."""
    frames = [
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
        .withColumn("label", F.lit(label))
        for label, path in folders.items()]
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def read_images(spark: SparkSession, path: str, keep_invalid: bool = False) -> DataFrame:
    """Image structs; files that are no image are dropped, or kept with width -1.  Spark skips files without bytes."""
    return (spark.read.format("image").option("dropInvalid", not keep_invalid).load(path)
            .select(F.col("image.origin").alias("file_path"), "image"))


def image_values(image: str = "image") -> Column:
    """The channel values of an image struct as whole numbers, row by row; null for a file that is no image."""
    data = F.col(image)["data"]
    places = F.sequence(F.lit(1), F.octet_length(data))
    values = F.transform(places, lambda i: F.conv(F.hex(F.substring(data, i, F.lit(1))), 16, 10).cast("int"))
    return F.when(F.col(image)["width"] > 0, values)


def image_features(images: DataFrame, side: int, image: str = "image") -> DataFrame:
    """Adds ``brightness``: the mean channel value, 0 to 1, of each cell of a ``side`` x ``side`` grid over the image.

    The array has ``side * side`` numbers whatever the image's size, so it can
    go into a model; it is null for a file that is no image, and a cell
    without pixels is 0.
    """
    shape = F.col(image)
    width, channels = shape["width"] * shape["nChannels"], shape["nChannels"]

    def cell(at: Column) -> Column:
        row, column = F.floor(at / width), F.floor((at % width) / channels)
        return F.floor(row * side / shape["height"]) * side + F.floor(column * side / shape["width"])

    def mean(values: Column, place: Column) -> Column:
        own = F.filter(values, lambda _, at: cell(at) == place)
        return F.coalesce(F.try_divide(F.aggregate(own, F.lit(0.0), lambda s, x: s + x), F.size(own) * 255.0), F.lit(0.0))

    return images.withColumn("_values", image_values(image)).withColumn("brightness", F.when(
        F.col("_values").isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda p: mean(F.col("_values"), p)))).drop("_values")


def inline_dimension(spark: SparkSession, rows: Mapping[str, str],
                     names: Sequence[str]) -> DataFrame:
    """A two-column dimension of literal rows; its size is fixed in the code."""
    first, second = names
    literal = F.array(*[
        F.struct(F.lit(a).alias(first), F.lit(b).alias(second)) for a, b in rows.items()])
    return spark.range(1).select(F.inline(literal))


def number_range(spark: SparkSession, size: int) -> DataFrame:
    return spark.sql("SELECT id FROM range(:size)", args={"size": size})


def squares(spark: SparkSession, size: int) -> DataFrame:
    wide = F.col("id").cast("decimal(19,0)")
    return number_range(spark, size).select("id", (wide * wide).alias("square"))


def cyclic_keys(df: DataFrame, number: str, keys: int, series: int) -> DataFrame:
    """Key, series and value computed from a running number."""
    n = F.col(number)
    return df.select(
        F.format_string("k_%03d", n % keys).alias("key"),
        F.concat(F.lit("group_"), (n % series).cast("string")).alias("series"),
        (n.cast("double") * n).alias("value"))


def expand_payload(df: DataFrame, payload: str, version: str,
                   schemas: Mapping[str, T.StructType], into: Iterable[str]) -> DataFrame:
    """Decode JSON payloads by the schema of their version; missing fields are null."""
    def field(name: str) -> Column:
        return F.coalesce(*[
            F.when(F.col(version) == label, F.from_json(payload, schema)[name])
            for label, schema in schemas.items() if name in schema.names])

    return df.withColumns({name: field(name) for name in into})


def decode_avro(df: DataFrame, payload: str, schema_json: str) -> DataFrame:
    """Avro payload to columns; needs the Spark Avro module on the class path."""
    from pyspark.sql.avro.functions import from_avro

    return df.withColumn("_record", from_avro(F.col(payload), schema_json)).select(
        *df.columns, "_record.*")
