"""Sparse rows in slices, as workers handle them. Nothing here imports pyspark.ml: with pandas it takes 30 MB of each worker."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows of a slice and numbers in it. The slices of a batch are multiplied together.
SLICE_ROWS, SLICE_NUMBERS = 1 << 13, 1 << 17


@dataclass
class Slice:
    """Sparse rows: row r has entries ``starts[r]``..``starts[r + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    numbers: np.ndarray
    y: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.y)), np.diff(self.starts))

    def times(self, v: np.ndarray) -> np.ndarray:
        """X v for a vector."""
        return np.bincount(self.rows, self.numbers * v[self.columns], len(self.y))

    def transposed(self, u: np.ndarray, width: int) -> np.ndarray:
        """X' u for a vector."""
        return np.bincount(self.columns, self.numbers * u[self.rows], width)


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of lists and where each list ends; null is an empty list."""
    lists = column.fill_null([]) if column.null_count else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind), np.cumsum(np.diff(lists.offsets.to_numpy()))


def _entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns and numbers of all entries of vectors, sparse or dense, and where each vector's entries end."""
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    numbers, ends = _flat(vectors.field("values"), np.float64)
    sizes = np.diff(ends, prepend=0)
    columns = np.arange(len(numbers)) - np.repeat(ends - sizes, sizes)
    columns[np.repeat(sparse, sizes)] = _flat(vectors.field("indices"), np.int64)[0]
    return columns, numbers, ends


def _all(arrays: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_entries`` of vectors that came as arrays."""
    numbers, ends = _flat(arrays, np.float64)
    sizes = np.diff(ends, prepend=0)
    return np.arange(len(numbers)) - np.repeat(ends - sizes, sizes), numbers, ends


def _parts(lists: pa.Array) -> Iterator[tuple[int, int]]:
    """Where runs of rows begin and end that make a slice each: all rows, by the lengths of their lists."""
    ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(ends):
        base = int(ends[begin - 1]) if begin else 0
        to = min(max(begin + 1, int(np.searchsorted(ends, base + SLICE_NUMBERS, "right"))), begin + SLICE_ROWS)
        yield begin, min(to, len(ends))
        begin = to


def _joined(column: pa.BinaryArray, kind: str) -> np.ndarray:
    """The numbers of all values one after the other, where they lie."""
    width = "<i8" if pa.types.is_large_binary(column.type) else "<i4"
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], "u1")[offsets[0] : offsets[-1]].view(kind) if offsets[-1] > offsets[0] else np.zeros(0, kind)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    """The slices of each batch as one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch.column("n").to_numpy()
        ends, y = _joined(batch.column("starts"), "<i8"), _joined(batch.column("y"), "<f8")
        sizes = np.delete(np.diff(ends), np.cumsum(rows + 1)[:-1] - 1)  # without the steps from one slice to the next
        yield Slice(np.append(0, np.cumsum(sizes)), _joined(batch.column("columns"), "<i4"), _joined(batch.column("numbers"), "<f8"), y)
