"""Inner equi-joins, and the aggregates that go with them.

Sums over a many-to-many join are computed from per-key counts and sums, so a
key that is frequent on both sides never expands into all its pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.workspace import small_side


def inner_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
               keep: Sequence[str]) -> DataFrame:
    """Inner join on pairs of column names, narrowed to ``keep``."""
    same = None
    for a, b in on:
        pair = left[a] == right[b]
        same = pair if same is None else same & pair
    return left.join(right, same, "inner").select(*keep)


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], salts: int = 16,
                    spread_by: Sequence[str] = ()) -> DataFrame:
    """Inner equi-join that spreads every key of ``left`` over ``salts`` tasks.

    ``spread_by`` names columns that tell rows apart, such as a message offset
    or an id, so that rows which otherwise hold only the key are spread too; a
    row gets the same task when a batch is run again.  Each right row is repeated once per salt, so ``right`` should be the side
    with few rows per key.  For joins adaptive execution cannot rebalance, as
    in streams; a batch join splits skewed keys by itself.
    """
    salt = F.pmod(F.xxhash64(*(spread_by or left.columns)), F.lit(salts)).cast("int")
    spread = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(spread, [*on, "_salt"]).drop("_salt")


def per_key(df: DataFrame, key: Column, sums: dict[str, Column], prefix: str,
            also: Sequence[str] = ()) -> DataFrame:
    """Row count and sums per key value (and the columns ``also``); null keys cannot match."""
    return (
        df.withColumn("join_key", key).filter(F.col("join_key").isNotNull())
        .groupBy("join_key", *also)
        .agg(F.count(F.lit(1)).alias(f"{prefix}_rows"),
             *[F.sum(c).alias(name) for name, c in sums.items()])
    )


def fanout_sums(left: DataFrame, right: DataFrame, left_sums: Sequence[str],
                right_sums: Sequence[str]) -> DataFrame:
    """Sums as a plain join of the details gives them: each side repeated per match.

    ``left`` and ``right`` come from ``per_key`` with prefixes ``left`` and
    ``right``; there is one result row per pair of their groups.
    """
    known = {"join_key", "left_rows", "right_rows", *left_sums, *right_sums}
    groups = [c for c in [*left.columns, *right.columns] if c not in known]
    left_rows, right_rows = (F.col(c).cast("decimal(19,0)") for c in ("left_rows", "right_rows"))
    return left.join(right, "join_key").select(
        "join_key", *groups, (left_rows * right_rows).alias("matches"),
        *[(F.col(c) * right_rows).alias(c) for c in left_sums],
        *[(F.col(c) * left_rows).alias(c) for c in right_sums])


def aggregated_sums(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sums with each side aggregated first, so that no row counts twice."""
    return left.join(right, "join_key").drop("left_rows", "right_rows")


def join_aggregate_back(df: DataFrame, group: Sequence[str], on: Sequence[str],
                        averages: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    """Group averages joined to the detail rows on some of the group's columns.

    The result has a row for each detail row and each group it shares the
    joined columns with, as the job asks for.  The averages are broadcast when
    they have been counted to be few, so the details are not shuffled.
    """
    means = df.groupBy(*group).agg(*[c.alias(name) for name, c in averages.items()])
    few = small_side(means.select(*on, *averages))
    return df.select(*on, *keep).join(few, list(on)).select(*averages, *keep)


def run_name(job: Column | str, run: Column | str) -> Column:
    """Text key ``job-<job>-run-<run>``."""
    return F.concat(F.lit("job-"), F.col(job).cast("string") if isinstance(job, str) else job,
                    F.lit("-run-"), F.col(run).cast("string") if isinstance(run, str) else run)


def distinct_match(left: DataFrame, right: DataFrame, key: str,
                   keep: Sequence[str]) -> DataFrame:
    """Distinct ``keep`` columns of an equi-join; duplicates go before the join, too."""
    a = left.select(key, *[c for c in keep if c in left.columns]).distinct()
    b = right.select(key, *[c for c in keep if c in right.columns]).distinct()
    return a.join(b, key).select(*keep).distinct()


def distinct_pair_count(pairs: DataFrame, names: DataFrame, key: str, item: str,
                        name: str) -> DataFrame:
    """Per name: how many rows the join of distinct (key, item) with (key, name) has."""
    items = pairs.select(key, item).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("_items"))
    holders = names.groupBy(key, name).agg(F.count(F.lit(1)).alias("_names"))
    return (
        holders.join(items, key).groupBy(name)
        .agg(F.sum(F.col("_items").cast("decimal(19,0)") * F.col("_names")).alias("n"))
    )


def fill_grid(counts: DataFrame, key: str, axis: str, measure: str, run: int = 10_000) -> DataFrame:
    """Every key with every step of a whole-number axis, 0 where nothing was counted.

    The axis reaches from its lowest to its highest value and is generated
    next to each key, ``run`` steps at a time, so no two tables are multiplied
    and no cell holds a long axis.
    """
    low, high = counts.agg(F.min(axis), F.max(axis)).first()
    if low is None:
        return counts.select(key, axis, measure)
    kind = counts.schema[axis].dataType
    begins = counts.select(key).distinct().withColumn(
        "_begin", F.explode(F.sequence(F.lit(low).cast("long"), F.lit(high).cast("long"), F.lit(run).cast("long"))))
    end = F.least(F.col("_begin") + (run - 1), F.lit(high).cast("long"))
    grid = begins.select(key, F.explode(F.sequence("_begin", end)).alias(axis)).withColumn(axis, F.col(axis).cast(kind))
    return grid.join(counts, [key, axis], "left").select(
        key, axis, F.coalesce(measure, F.lit(0)).alias(measure))
