"""Mixing sources to target weights by systematic sampling.

A source's documents all expect the same number of copies, target words over
source words.  They are put in order of size, the expected copies are summed
up in that order, one random offset per source is added, and a document is
emitted once for each whole number that the sum crosses.  Because neighbours
in the order are of similar size, the words taken miss the target by about
one large document.  Sums are whole numbers of 2**-20 copies, so reruns agree
and no order of addition matters.

Defined results: a null text has no words and takes none; null is a source of
its own, last in order; equal rows are separate documents; a source without
words has target 0; an empty table gives no rows; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.ordering import with_position
from tallyloom.workspace import materialise

UNIT_BITS = 20
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sized: DataFrame, cap: int = 3) -> DataFrame:
    """Per source: _source, source_size, target.  ``sized`` has ``_source`` and ``_size``.

    Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ... and
    share the words of all.  Sources that would get more than ``cap`` times
    their own words get just that; the rest share what is left by weight.
    One row per source passes through one task here, never the documents.
    """
    sums = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    ranked = sums.withColumn("_w", (F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1) % 3 + 1)
    # fewest words per weight reach the cap first; 6 / weight is whole
    order = [F.col("source_size") * (F.lit(6) / F.col("_w")).cast("long"), F.col("_source").asc_nulls_last()]
    whole, before = W.partitionBy(), W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    upto = W.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    big = "decimal(28,0)"
    left_words = F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    left_weight = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    reached = (cap * F.col("source_size")).cast(big) * left_weight.cast("decimal(10,0)") <= (
        F.col("_w").cast("decimal(10,0)") * left_words.cast(big))
    full = ranked.withColumn("_reached", reached.cast("int")).withColumn("_full", F.min("_reached").over(upto) == 1)
    rest = full.withColumn(
        "_words", F.sum("source_size").over(whole) - cap * F.sum(F.when(F.col("_full"), F.col("source_size")).otherwise(0)).over(whole)
    ).withColumn("_weight", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(whole))
    share = (F.col("_w") * F.col("_words")).cast("double") / F.col("_weight").cast("double")
    return rest.select("_source", "source_size", F.when(
        F.col("_full"), (cap * F.col("source_size")).cast("double")).otherwise(share).alias("target"))


def offset(source: Column, seed: str) -> Column:
    """A whole number below 2**UNIT_BITS, by the hash of seed and source."""
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(source, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, UNIT_BITS // 4), 16, 10).cast("long")


def with_copies(docs: DataFrame, size: Column, source: Column, tie: Column,
                seed: str = "mix", cap: int = 3) -> DataFrame:
    """Each row as ``_doc`` with _size, _source, source_size, target and _copies: how often it enters the mix.

    ``tie`` orders rows of equal size; rows equal in that too are interchangeable.
    """
    sized = docs.select(F.struct(*docs.columns).alias("_doc"), size.alias("_size"), source.alias("_source"),
                        tie.alias("_order"), F.monotonically_increasing_id().alias("_tie"))
    plan = targets(sized.select("_source", "_size"), cap)
    placed = with_position(sized, ["_source"], ["_size", "_order", "_tie"], "_position").withColumnRenamed("_source", "_from")
    joined = placed.join(plan, placed["_from"].eqNullSafe(plan["_source"]))
    unit = 1 << UNIT_BITS
    each = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * unit)).otherwise(0).cast("long")
    upto = offset(F.col("_source"), seed) + each * F.col("_position")
    return joined.withColumn("_copies", F.shiftright(upto, UNIT_BITS) - F.shiftright(upto - each, UNIT_BITS)).drop(
        "_from", "_position", "_order", "_tie")


def mix_sources(docs: DataFrame, seed: str = "mix", cap: int = 3) -> DataFrame:
    """The mix itself: each document of ``docs`` as many times as its copies, columns as they were."""
    copies = with_copies(docs, word_count(F.col("text")), F.col("source"),
                         F.struct("doc_id", F.xxhash64("text")), seed, cap)
    return copies.where("_copies > 0").select(
        "_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_doc.*")


def mix_report(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    narrow = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                     F.xxhash64("text").alias("hash")), "sizes")  # the texts are read once
    return with_copies(narrow, F.col("size"), F.col("source"), F.struct("doc_id", "hash"), seed).select(
        "_doc.doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_copies") * F.col("_size")).alias("taken"))
