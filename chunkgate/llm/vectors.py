"""Rows of vectors on their way into numpy: which count, and as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkgate.llm.tiles import floats

#: So many numbers of a batch are worked on at once.
BLOCK_NUMBERS = 1 << 18


def finite(vector: str | Column, limit: float = float("inf")) -> Column:
    """Whether a vector is there and holds only finite numbers, all smaller in size than ``limit``."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    entries = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < limit))
    return F.coalesce(vector.isNotNull() & entries, F.lit(False))


def common_length(rows: DataFrame, vector: str) -> int:
    """The length that most vectors have, the larger one of two that are as common; 0 without vectors."""
    counts = rows.groupBy(F.size(vector).alias("size")).count()
    row = counts.where("size > 0").orderBy(F.desc("count"), F.desc("size")).first()
    return row["size"] if row else 0


def matrices(batches: Iterator[pa.RecordBatch], vector: str, max_rows: int = 1 << 14) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of bounded size of the rows, each with its vectors (all of one length) as a matrix."""
    for batch in batches:
        if not batch.num_rows:
            continue
        width = len(batch.column(vector)[0])
        step = max(1, min(max_rows, BLOCK_NUMBERS // width))
        for at in range(0, batch.num_rows, step):
            piece = batch.slice(at, step)
            yield piece, floats(piece.column(vector)).astype(np.float64, copy=False)
