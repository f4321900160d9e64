"""Comparing the rows of a group with each other in tasks of bounded size.

A group of n rows is cut into ``ceil(n / size)`` tiles by a hash of its rows' ids, and each pair of
tiles is a cell of at most two tiles' rows. No group is held by one task, no pair of rows is a row:
the cell's task compares its rows in numpy and returns sums and a spanning forest of what it found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.sources.tables import stored


def cells(rows: DataFrame, group: str, row_id: str, size: int, label: str = "groups") -> DataFrame:
    """Rows of groups of two and more, once for each cell they belong to, with columns cell, tile, low, high.

    A cell compares tile ``low`` with tile ``high``; rows carry their own ``tile``.
    """
    counts = stored(rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), label)
    out = rows.join(counts, group).withColumn("tiles", F.ceil(F.col("n") / size).cast("int"))
    out = out.withColumn("tile", F.pmod(F.xxhash64(row_id, F.lit("tile")), F.col("tiles")).cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    out = out.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
    return out.withColumn("cell", F.xxhash64(group, "low", "high")).drop("n", "tiles", "other")


def compare(placed: DataFrame, kernel: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run ``kernel`` on the rows of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            keys = batch.column("cell").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            for a, b in zip(edges[:-1], edges[1:]):
                if b == a:
                    continue
                if held and keys[a] != current:
                    yield from kernel(pa.Table.from_batches(held).combine_chunks())
                    held = []
                current = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from kernel(pa.Table.from_batches(held).combine_chunks())

    return placed.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, schema)


def forest(n: int, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest id that links reach inside the cell."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    a, b = rank[left], rank[right]
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return ids[order][root][rank]


def floats(column: pa.ChunkedArray) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)
