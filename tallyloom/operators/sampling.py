"""Samples, splits and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.workspace import materialise


def hash_bucket(key: str, buckets: int = 100) -> Column:
    """Bucket of a whole-number key from plain arithmetic, the same in every engine."""
    # The multiplier of Knuth's multiplicative hash and its modulus;
    # keys are first cut to 31 bits so that the product fits a long.
    low = F.pmod(F.col(key), F.lit(2147483648))
    return low * F.lit(2654435761) % F.lit(4294967296) % buckets


def key_hash(key: str) -> Column:
    """32 bits from a whole-number key by the arithmetic of ``hash_bucket``."""
    return F.pmod(F.col(key), F.lit(2147483648)) * F.lit(2654435761) % F.lit(4294967296)


DIGIT_BITS = 16  # a round counts at most 2**16 cells


def smallest(df: DataFrame, columns: Sequence[Column], k: int) -> tuple[Column, int, int]:
    """Which rows are the k smallest by whole-number ``columns``: (rows certainly below, rows still wanted of the tied, tied).

    Each round counts the rows by the next 16 bits inside the cell that holds
    the k-th, so nothing is sorted and only those counts leave the tasks.  The
    condition takes in all rows up to the k-th; where several rows tie with it,
    the numbers tell how many of how many are wanted.
    """
    tied, below, wanted, held = F.lit(True), F.lit(False), k, None
    for column in columns:
        low = column.cast("long").bitwiseXOR(F.lit(-(1 << 63)))  # so that negative numbers come first
        prefix = 0
        for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
            digit = F.shiftrightunsigned(low, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
            here = tied if shift + DIGIT_BITS == 64 else tied & (F.shiftrightunsigned(low, shift + DIGIT_BITS) == prefix)
            cells = sorted(df.where(here).groupBy(digit.alias("digit")).count().collect())
            for cell, count in cells:
                if wanted <= count:
                    break
                wanted -= count
            prefix, held = prefix << DIGIT_BITS | cell, count
            if wanted == held:  # the whole cell is wanted
                top = F.shiftrightunsigned(low, shift)
                return below | (tied & (_unsigned(top, shift) <= _literal(prefix, shift))), 0, 0
        value = prefix - (1 << 63)
        below |= tied & (column < value)
        tied &= column == value
    return below, wanted, held


def _unsigned(top: Column, shift: int) -> Column:
    return top if shift else top.bitwiseXOR(F.lit(-(1 << 63)))


def _literal(prefix: int, shift: int) -> Column:
    return F.lit(prefix if shift else prefix - (1 << 63))


def sample_exact(df: DataFrame, key: str, size: int | None = None, fraction: float | None = None) -> DataFrame:
    """Exactly ``size`` rows, or ``floor(fraction * rows)``, without replacement; all rows if there are no more.

    Rows are chosen by the hash of a whole-number ``key``, then by the key; so
    the same rows come again however they are laid out.  Of rows that share a
    key any are taken.  Rows without a key come after all others.
    """
    total = df.count()
    size = int(fraction * total) if size is None else size
    if size >= total or size <= 0:
        return df if size > 0 else df.limit(0)
    number = F.col(key).cast("long")
    order = [F.coalesce(key_hash(key), F.lit(1 << 32)), F.coalesce(number, F.lit(0))]
    certain, wanted, tied = smallest(df, order, size)
    if not wanted:
        return df.where(certain)
    # rows of one key: numbered where they lie, as they cannot be told apart by it
    columns = df.columns
    marked = materialise(df.select(F.struct(*columns).alias("_row"), *[c.alias(f"_o{i}") for i, c in enumerate(order)],
                                   F.monotonically_increasing_id().alias("_at")), "sample")
    condition, _, _ = smallest(marked, [F.col("_o0"), F.col("_o1"), F.col("_at")], size)
    return marked.where(condition).select(*[F.col("_row").getField(c).alias(c) for c in columns])


def hash_split(df: DataFrame, key: str, percent: int, name: str = "is_train") -> DataFrame:
    """Mark about ``percent`` of the rows; a key always gets the same mark."""
    return df.withColumn(name, hash_bucket(key) < percent)


def stratified_split(df: DataFrame, key: str, label: str, percent: dict) -> DataFrame:
    """Mark a share of each label's rows; labels without a share are all test rows."""
    share = F.coalesce(
        F.create_map(*[F.lit(x) for pair in percent.items() for x in pair])[F.col(label)],
        F.lit(0))
    return df.withColumn("is_train", hash_bucket(key) < share)


def random_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def rows_not_in(df: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    return df.join(sample.select(key), key, "left_anti")


def difference(df: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that ``other`` lacks.

    Both sides lose their duplicates before they meet, so a row that is very
    frequent arrives once per task.
    """
    return df.distinct().subtract(other.distinct())


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.union(frame)
    return first
