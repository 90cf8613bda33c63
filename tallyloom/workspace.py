"""Scratch tables in the shared folder the cluster names.

``spark.checkpoint.dir`` is the only place intermediate tables, staged files
and stream checkpoints go, so a lost executor never loses them.  A local
master with no such setting gets a temporary folder of its own; a cluster
without the setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_FOLDERS: dict[str, str] = {}
_OWNERS: list[list[str]] = []

# Largest table, in bytes of Parquet, that is broadcast.
SMALL_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    application = context.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="tallyloom-")
    return _LOCAL_FOLDERS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses; the ``scratch`` block it is made in owns it."""
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _OWNERS:
        _OWNERS[-1].append(path)
    return path


def table_name(path: str) -> str:
    """The catalog name of a table kept at a scratch path."""
    return path.rsplit("/", 1)[1].replace("-", "_")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns the scratch tables made inside it and removes them at its end.

    Results read those tables, so write the result inside the block.
    """
    made: list[str] = []
    _OWNERS.append(made)
    try:
        yield
    finally:
        _OWNERS.remove(made)
        for path in made:
            spark.sql(f"DROP TABLE IF EXISTS `{table_name(path)}`")
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _bytes(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tallyloom/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once no result that reads them is needed."""
    _delete(spark, _own_folder(spark))


def scratch_name(name: str) -> str:
    """A table, view or stream name that no other run uses."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and fixes the values."""
    return _written(df, name)[0]


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def bounded_rows(df: DataFrame, max_rows: int) -> pa.Table | None:
    """All rows of ``df`` if there are at most ``max_rows``, else None.

    Never more than ``max_rows + 1`` rows reach the driver.
    """
    table = df.limit(max_rows + 1).toArrow()
    return table if table.num_rows <= max_rows else None


def sized(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` written once, and whether its files have at most ``max_bytes`` (``SMALL_BYTES``)."""
    kept, path = _written(df, "side")
    return kept, _bytes(df.sparkSession, path) <= (SMALL_BYTES if max_bytes is None else max_bytes)


def small_side(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``df`` written once, and broadcast if it is small by ``sized``.

    Nothing passes through the driver.  Beyond the limit the join stays a
    shuffle join with AQE skew handling; either way ``df`` is computed once.
    """
    kept, small = sized(df, max_bytes)
    return F.broadcast(kept) if small else kept


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which a null key matches a null key, as it does in a grouping."""
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    renamed = right.withColumnsRenamed(names)
    same = F.lit(True)
    for k, name in names.items():
        same = same & left[k].eqNullSafe(renamed[name])
    return left.join(renamed, same).drop(*names.values())


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` for several uses inside a ``with`` block, then let it go."""
    kept = df.persist()
    try:
        yield kept
    finally:
        kept.unpersist()
