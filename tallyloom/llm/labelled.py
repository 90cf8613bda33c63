"""Training rows for the classifiers: a bounded sample of labelled documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows a classifier is fitted on.  They are the first by a hash of the id, so any
#: larger set of labels gives a sample of the same make-up.
SAMPLE = 5_000


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id written as text, modulo ``by``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % by, F.lit(0).cast("long"))


def sample_features(docs: DataFrame, labels: DataFrame, label: str,
                    features: Callable[[pa.Array], Iterator[np.ndarray]], most: int = SAMPLE,
                    ) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature arrays and labels of at most ``most`` labelled rows whose id is not held out.

    Rows without a label, an id or a document are left out.  The chosen
    labels are broadcast, being bounded; documents are read once and only
    features of the chosen ones come to the driver, compressed.  There they lie
    in one array, which goes back to the system as a whole after the fit.
    """
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 4) != 2))
              .select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")).distinct()
              .orderBy(F.xxhash64("_id"), "_id", "_label").limit(most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for b in batches:
            found = [pack.compress(np.diff(f.astype("<u4"), prepend=np.uint32(0)).tobytes()) for f in features(b.column("_text"))]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_label"), pa.array(found, pa.binary())],
                                             ["_id", "_label", "_features"])

    rows = (docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"))
            .join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_id", "_label", "_text")
            .mapInArrow(run, "_id long, _label int, _features binary").limit(2 * most).toArrow())
    order = np.lexsort((rows.column("_label").to_numpy(), rows.column("_id").to_numpy()))
    chosen_labels = rows.column("_label").to_numpy()[order]
    found = _unpacked([rows.column("_features")[int(i)].as_buffer() for i in order])
    del rows
    pa.default_memory_pool().release_unused()
    return found, chosen_labels


def _unpacked(packed: list[pa.Buffer]) -> list[np.ndarray]:
    """Parts of one array, each the running sums of a compressed buffer."""
    sizes = [zstandard.frame_content_size(x) // 4 for x in packed]
    ends = np.cumsum(sizes, dtype=np.int64)
    whole, unpack = np.empty(sum(sizes), np.uint32), zstandard.ZstdDecompressor()
    parts = [whole[end - n: end] for n, end in zip(sizes, ends)]
    for part, x in zip(parts, packed):
        if len(part):
            np.cumsum(np.frombuffer(unpack.decompress(x), "<u4"), dtype=np.uint32, out=part)
    return parts
