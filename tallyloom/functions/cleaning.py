"""Column expressions that turn messy fields into clean ones."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How many thousands one unit of each money suffix is worth.
THOUSANDS = {"K": 1.0, "M": 1_000.0, "B": 1_000_000.0}

def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(code: Column | str, book: Mapping, default: str | None = None) -> Column:
    """Label of a code; a code missing from the book becomes ``default`` (null)."""
    entries = [F.lit(x) for pair in book.items() for x in pair]
    label = F.create_map(*entries)[_column(code)]
    return label if default is None else F.coalesce(label, F.lit(default))


def decode_all(df: DataFrame, books: Mapping[str, Mapping], suffix: str = "_str") -> DataFrame:
    """Add ``<column>_str`` for every column that has a code book."""
    return df.withColumns({f"{c}{suffix}": decode(c, book) for c, book in books.items()})


def unknown_bucket(c: Column | str, label: str = "Unknown") -> Column:
    return F.coalesce(_column(c), F.lit(label))


def merge_labels(c: Column | str, patterns: Mapping[str, str]) -> Column:
    """First label whose pattern is found anywhere in the text, else upper case."""
    c = _column(c)
    merged = None
    for label, pattern in patterns.items():
        found = c.rlike(f"(?i){pattern}")
        merged = F.when(found, label) if merged is None else merged.when(found, label)
    return F.upper(c) if merged is None else merged.otherwise(F.upper(c))


def parse_magnitude(c: Column | str, missing: str | None = "0.00K") -> Column:
    """``'10.5K'`` style text as thousands; other suffixes and bad numbers are null."""
    c = _column(c)
    text = c if missing is None else F.coalesce(c, F.lit(missing))
    parsed = None
    for suffix, factor in THOUSANDS.items():
        number = F.regexp_replace(text, suffix, "").try_cast("double") * F.lit(factor)
        ends = text.endswith(suffix)
        parsed = F.when(ends, number) if parsed is None else parsed.when(ends, number)
    return parsed


def scale_by_unit(amount: Column | str, unit: Column | str,
                  legacy_crop: bool = False) -> Column:
    """Amount with a separate magnitude letter, as millions.

    Letters other than K and B leave the amount as it is.  ``legacy_crop``
    keeps the historic rule for crop damage, where B is not scaled either.
    """
    amount, unit = _column(amount).cast("double"), _column(unit)
    scaled = F.when(unit == "K", amount / F.lit(1_000.0))
    if not legacy_crop:
        scaled = scaled.when(unit == "B", amount * F.lit(1_000.0))
    return scaled.otherwise(amount)


def typed_value(kind: Column | str, text: Column | str) -> Column:
    """Yes/No answers as 1/0, anything else as a number or null."""
    kind, text = _column(kind), _column(text)
    return (F.when(kind == "Yes/No", F.when(text == "Yes", 1.0).otherwise(0.0))
            .otherwise(text.try_cast("double")))


def value_unit(kind: Column | str, unit: Column | str | None = None) -> Column:
    """Unit of a typed value.  Without ``unit`` the kind stands in for it, the historic rule."""
    kind = _column(kind)
    other = kind if unit is None else _column(unit)
    return F.when(kind == "Yes/No", F.lit("Binary")).otherwise(other)


def not_blank(c: Column | str) -> Column:
    c = _column(c)
    return c.isNotNull() & (F.trim(c) != "")


def add_columns(columns: Iterable[Column | str]) -> Column:
    """Sum that is null as soon as one part is null."""
    first, *rest = [_column(c) for c in columns]
    total = first
    for c in rest:
        total = total + c
    return total


def normal_key(c: Column | str) -> Column:
    """Join key: lower case with every blank as an underscore."""
    return F.regexp_replace(F.lower(_column(c)), " ", "_")


def safe_file_name(c: Column | str) -> Column:
    return F.regexp_replace(_column(c), "[ ()]", "")


def chunk_file_name(name: Column | str, chunk: Column | str) -> Column:
    return safe_file_name(F.concat(
        _column(name), F.lit("_Chunk"), _column(chunk).cast("string"), F.lit(".json")))


def year_of_text_date(c: Column | str) -> Column:
    """Year of ``'4/18/1950 0:00:00'``; text that is no date is null."""
    day = F.split(_column(c), " ")[0]
    return F.year(F.try_to_date(day, "M/d/yyyy"))


def epoch_timestamp(c: Column | str) -> Column:
    return F.timestamp_seconds(_column(c))


def date_parts(c: Column | str, prefix: str = "") -> dict[str, Column]:
    c = _column(c)
    return {f"{prefix}year": F.year(c), f"{prefix}month": F.month(c),
            f"{prefix}day": F.dayofmonth(c)}


def exact(c: Column | str, scale: int = 2) -> Column:
    """Money-like doubles as decimals, so that sums do not depend on row order."""
    return _column(c).cast(f"decimal(18,{scale})")


def whole_total(c: Column | str) -> Column:
    """Sum of whole numbers that may outgrow a long, as a double."""
    return F.sum(_column(c).cast("decimal(20,0)")).cast("double")


def exact_mean(c: Column | str, scale: int = 2) -> Column:
    """Average as an exact sum over the count."""
    return F.sum(exact(c, scale)).cast("double") / F.count(_column(c))
