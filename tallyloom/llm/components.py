"""Connected components of a table of links, by alternating stars.

Each round reduces every node's neighbours to the least one; the links stay a
table throughout and are cut from their lineage by writing them.  Every round
is many jobs to the driver, so none is run on links that are stars already,
and links found later are added between components, not between nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.workspace import materialise


def _least(edges: DataFrame, large: bool) -> DataFrame:
    """One star round: neighbours of each node point to the least of node and neighbours."""
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = near.join(least, "a")
    if large:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node of ``edges`` (a > b, distinct) has either one link to a smaller node or none."""
    ends = edges.select("a", F.lit(1).alias("out")).union(edges.select(F.col("b").alias("a"), F.lit(0).alias("out")))
    seen = ends.groupBy("a").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
    return not seen.agg(F.max((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("least") == 0)))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (a, b) and the least node it is connected to."""
    edges = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not _stars(edges):
        edges = materialise(_least(_least(edges, True), False), "edges")
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def joined_components(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups``, as ``components`` gives them, after more ``links`` (a, b) between any nodes."""
    ends = links
    for end in ("a", "b"):
        known = groups.select(F.col("node").alias(end), F.col("root").alias("_root"))
        ends = ends.join(known, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    moved = components(ends.select("a", "b"))
    every = groups.union(moved.select("node", F.col("node").alias("root"))).distinct()
    return every.join(moved.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left").select(
        "node", F.coalesce("_to", "root").alias("root"))
