"""Windows that have been reported, and what late rows change in them.

Every window of every key has its count in keyed state.  A batch that adds rows
to a window gives one row with the count before and after, so a reader who adds
up the differences has the counts of all rows so far, whatever the batches
were.  A window is forgotten once the watermark has passed its end; rows that
come later than that are left out.

Rows are counted per key and window before they are moved, in the batches they
are read in, so a key that holds most rows of a window arrives as a few counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key and window of each batch."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["key", "window_start"]).aggregate([([], "count_all")])
        counts = table.select(["key", "window_start", "count_all"]).rename_columns(["key", "window_start", "n"])
        yield from counts.combine_chunks().to_batches()


def _corrected(length: int):
    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        key, start = group
        added = sum(int(part["n"].sum()) for part in parts)
        until = int(pd.Timestamp(start).timestamp() * 1000) + length * 1000
        if until <= state.getCurrentWatermarkMs():
            return
        before = state.get[0] if state.exists else 0
        state.update((before + added,))
        state.setTimeoutTimestamp(until)
        yield pd.DataFrame({"key": [key], "window_start": [start], "before": [before], "after": [before + added]})
    return run


def window_corrections(stream: DataFrame, time: str, key: str, length: int, late: int) -> DataFrame:
    """key (as text), window_start, before, after: one row for each window that a batch changes.

    Windows of ``length`` seconds begin at multiples of it.  A window takes
    rows until the stream has seen one whose window ends ``late`` + ``length``
    seconds after its own, so it takes all rows that are at most ``late``
    seconds late.  Null keys are keys; rows without a time take no part.
    """
    seconds = F.unix_timestamp(time)
    rows = stream.where(F.col(time).isNotNull()).select(
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("key"),
        F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(length))).alias("window_start"))
    # a window is late, or not, as a whole
    counted = rows.mapInArrow(_counted, "key string, window_start timestamp, n long").withColumn(
        "_end", F.timestamp_seconds(F.unix_timestamp("window_start") + length)).withWatermark("_end", f"{late + length} seconds")
    found = counted.groupBy("key", "window_start").applyInPandasWithState(
        _corrected(length), "key string, window_start timestamp, before long, after long", "n long", "append",
        GroupStateTimeout.EventTimeTimeout)
    return found.withColumn("key", F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)))
