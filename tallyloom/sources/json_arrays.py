"""JSON arrays of objects read in parallel, however large a file is.

A file is cut at every ``}``, which Spark's text source can do from any byte
on, so many tasks read one file.  Whether a cut lies in a string depends on
all quotes before it, and how deep it lies on all brackets outside strings
before it.  Both are sums: each split adds up its own, one row per split gives
the sums of the splits before, and a running sum inside the split gives the
state at every cut.  Where a cut is outside strings and back at the depth of
the array, a record ends; the pieces of a record are put together and parsed.

A file may also hold a single object or objects one after the other.  Defined
results: whatever follows the last whole record, save white space, commas and
brackets, is one row of nulls, as is a record that does not fit the schema;
an empty array or file gives no rows; fields that the schema does not name are
left out.  A record must fit a row, not a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.workspace import small_side

# an escaped character, a whole string, and what may stand between records
ESCAPED, STRING, BETWEEN = r"\\.", '"[^"]*"', r"^[\s,\[\]]+|[\s,\[\]]+$"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """_file, _split (its first byte), _id (order in it), _text up to a cut."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("_text"))


def _bare(text: Column, inside: Column) -> Column:
    """What stands outside strings, given whether the text begins inside one."""
    plain = F.regexp_replace(text, F.lit(rf"(?s){ESCAPED}"), F.lit(""))
    whole = F.when(inside, F.concat(F.lit('"'), plain)).otherwise(plain)
    # a string that is open at the end goes on to the end
    return F.regexp_replace(F.regexp_replace(whole, F.lit(STRING), F.lit("")), F.lit('(?s)".*'), F.lit(""))


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _before(pieces: DataFrame, amount: str, name: str) -> DataFrame:
    """Adds the sum of ``amount`` over all pieces of the file before this one."""
    within = W.partitionBy("_file", "_split").orderBy("_id").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("_file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    starts = pieces.groupBy("_file", "_split").agg(F.sum(amount).alias("_all")).select(
        "_file", "_split", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_start"))
    return pieces.join(small_side(starts), ["_file", "_split"]).withColumn(
        name, F.col("_start") + F.coalesce(F.sum(amount).over(within), F.lit(0))).drop("_start")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The objects of the JSON arrays in the files of ``path``, one row each."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    plain = F.regexp_replace("_text", F.lit(rf"(?s){ESCAPED}"), F.lit(""))
    pieces = _before(_pieces(spark, path).withColumn("_quotes", _count(plain, '"')), "_quotes", "_quoted")
    bare = _bare(F.col("_text"), F.col("_quoted") % 2 == 1)
    files = pieces.groupBy("_file").agg(
        # a file that ends in a cut has one separator for each piece
        (F.sum(F.octet_length("_text") + 1) == F.max("_size")).alias("_closed"), F.max(F.struct("_split", "_id")).alias("_last"),
        F.min_by(F.ltrim("_text"), F.struct("_split", "_id")).startswith("[").cast("int").alias("_base"))
    pieces = pieces.join(small_side(files), "_file").withColumn(
        "_cut", (((F.col("_quoted") + F.col("_quotes")) % 2 == 0)
                 & (F.col("_closed") | (F.struct("_split", "_id") != F.col("_last"))))).withColumn(
        "_depth", _count(bare, "[{") - _count(bare, "]}") - F.col("_cut").cast("long"))
    pieces = _before(pieces, "_depth", "_deep").withColumn(
        "_ends", (F.col("_cut") & (F.col("_deep") + F.col("_depth") == F.col("_base"))).cast("long"))
    numbered = _before(pieces, "_ends", "_record")
    separator = F.when(F.col("_closed") | (F.struct("_split", "_id") != F.col("_last")), "}").otherwise("")
    records = numbered.groupBy("_file", "_record").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_split", "_id", F.concat("_text", separator).alias("t")))),
                                 lambda s: s["t"]), "").alias("_text"))
    body = F.regexp_replace("_text", F.lit(BETWEEN), F.lit(""))
    # a whole record ends in its brace; a rest without one keeps its brackets apart from being empty
    return records.select(body.alias("_text")).where("_text <> ''").select(
        F.from_json("_text", fields).alias("_record")).select(*[F.col("_record").getField(f).alias(f) for f in fields.names])
