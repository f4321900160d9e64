"""Vector compression with a dictionary of values for each dimension.

Vectors of integers are cut into parts, and each part is replaced by the number of its nearest codebook
entry. Rows lie in slices of bounded size. A slice keeps, for each dimension, the distinct integers that
occur in it and, instead of the vectors, their numbers in that dictionary. To find nearest entries a
round tabulates, for each dimension, the squared difference of every distinct integer to that dimension
of all entries; the distance of a part is then a sum of rows gathered from the tables. Nothing is
multiplied for a vector, and the slices, written once, serve all rounds.

Only the codebooks (parts times entries) and their sums pass the driver; all arithmetic is in integers.

Defined results: rows without a vector, with null or non-finite entries, or with integers of 2^27 and more
in size (their sums of squares would leave a long) are left out; so are vectors that have not the commonest
length. Dimensions that parts do not divide evenly fill the first parts. The codebooks start from the rows
with the smallest vec_ids, null ids last, rows of one id in order of their vectors; fewer rows give fewer
entries. Repeated ids are rows of their own. Null labels belong together, as do NaN; a sum of errors beyond a
long is null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from chunkgate.llm.vectors import common_length, finite, matrices
from chunkgate.sources.tables import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256.0
SLICE_ROWS = 2048
_LARGEST = float(1 << 27)

Codebook = list[np.ndarray]


def part_bounds(dims: int, parts: int) -> list[tuple[int, int]]:
    width = -(-dims // parts)
    return [(min(p * width, dims), min((p + 1) * width, dims)) for p in range(parts)]


def vector_rows(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """vec_id, label and ``x``, the integers floor(scale * embedding), of the rows that count."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.where(finite("e", _LARGEST / scale) & (F.size("e") > 0))
    return rows.select("vec_id", "label", F.transform("e", lambda c: F.floor(F.lit(scale) * c).cast("long")).alias("x"))


def with_dictionaries(rows: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The slices: vec_ids, labels, and for all dimensions one after another the dictionary sizes, the values and the codes."""
    label = rows.schema["label"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, x in matrices(batches, "x", slice_rows):
            found = [np.unique(column, return_inverse=True) for column in x.astype(np.int64).T]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([piece.column("vec_id")], pa.list_(pa.int64())), pa.array([piece.column("label")], pa.list_(to_arrow_type(label))),
                    pa.array([[len(values) for values, _ in found]], pa.list_(pa.int32())),
                    pa.array([np.concatenate([values for values, _ in found])], pa.list_(pa.int64())),
                    pa.array([np.stack([codes for _, codes in found]).astype("<u2").tobytes()], pa.binary()),
                ],
                ["vec_ids", "labels", "sizes", "values", "codes"],
            )

    schema = T.StructType([
        T.StructField("vec_ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label)), T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("values", T.ArrayType(T.LongType())), T.StructField("codes", T.BinaryType()),
    ])
    return rows.mapInArrow(run, schema)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
    """Each slice as a row, its dictionaries, and the codes of each dimension."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            sizes = np.asarray(row.column("sizes")[0].values)
            values = np.split(np.asarray(row.column("values")[0].values), np.cumsum(sizes)[:-1])
            codes = np.frombuffer(row.column("codes")[0].as_py(), "<u2").reshape(len(sizes), -1)
            yield row, values, codes


def nearest(values: list[np.ndarray], codes: np.ndarray, book: Codebook, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """For each row and part the number of its nearest entry (the lowest of equals), and the squared distance."""
    found, far = (np.zeros((codes.shape[1], len(bounds)), np.int64) for _ in range(2))
    for p, (a, b) in enumerate(bounds):
        distance = np.zeros((codes.shape[1], len(book[p])), np.int64)
        for d in range(a, b):
            table = (values[d][:, None] - book[p][:, d - a]) ** 2
            distance += table[codes[d]]
        found[:, p] = distance.argmin(axis=1)
        far[:, p] = distance[np.arange(len(distance)), found[:, p]]
    return found, far


def first_codebook(rows: DataFrame, bounds: list[tuple[int, int]], entries: int) -> Codebook:
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    x = np.array([r["x"] for r in first], np.int64)
    return [x[:, a:b] for a, b in bounds]


def _part_sums(book: Codebook, bounds: list[tuple[int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(entries), np.int64) for entries in book]
        sums = [np.zeros_like(entries) for entries in book]
        for _, values, codes in _opened(batches):
            found, _ = nearest(values, codes, book, bounds)
            for p, (a, b) in enumerate(bounds):
                counts[p] += np.bincount(found[:, p], minlength=len(book[p]))
                for d in range(a, b):  # a slice's sums are below 2^53
                    sums[p][:, d - a] += np.bincount(found[:, p], values[d][codes[d]], len(book[p])).astype(np.int64)
        for p in range(len(bounds)):
            used = np.flatnonzero(counts[p])
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[p][used]),
                        pa.array(list(sums[p][used]), pa.list_(pa.int64())),
                    ],
                    ["part", "entry", "n", "sums"],
                )

    return run


def next_codebook(slices: DataFrame, book: Codebook, bounds: list[tuple[int, int]]) -> Codebook:
    """Each entry becomes the floor of the mean of the parts nearest to it; unused ones stay."""
    partial = slices.mapInArrow(_part_sums(book, bounds), "part int, entry int, n long, sums array<long>")
    width = max(b - a for a, b in bounds)
    totals = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(k)).cast("decimal(38,0)")) for k in range(width)]).alias("sums")
    )
    out = [entries.copy() for entries in book]
    for row in totals.collect():  # parts times entries
        p = row["part"]
        out[p][row["entry"]] = [int(s) // row["n"] for s in row["sums"][: out[p].shape[1]]]
    return out


def codebooks_digest(book: Codebook) -> str:
    return hashlib.sha256(",".join(str(int(v)) for entries in book for v in entries.ravel()).encode()).hexdigest()


def _coded(book: Codebook, bounds: list[tuple[int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, values, codes in _opened(batches):
            found, far = nearest(values, codes, book, bounds)
            data = found.astype(np.uint8).tobytes().hex()
            size = 2 * len(bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    row.column("vec_ids").flatten(), row.column("labels").flatten(),
                    pa.array([data[k * size : (k + 1) * size] for k in range(len(found))]), pa.array(far.sum(axis=1)),
                ],
                ["vec_id", "label", "code", "error"],
            )

    return run


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE) -> tuple[DataFrame, Codebook]:
    """vec_id, label, code, error of each row (stored), and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has room for 256 entries of a part")
    rows = vector_rows(vectors, scale)
    bounds = part_bounds(common_length(rows, "x"), parts)
    dims = bounds[-1][1]
    schema = T.StructType([rows.schema["vec_id"], vectors.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not dims:
        return vectors.sparkSession.createDataFrame([], schema), []
    rows = rows.where(F.size("x") == dims)
    slices = stored(with_dictionaries(rows), "value-codes")
    book = first_codebook(rows, bounds, entries)
    for _ in range(rounds):
        book = next_codebook(slices, book, bounds)
    return stored(slices.mapInArrow(_coded(book, bounds), schema), "vector-codes"), book


def decode(coded: DataFrame, book: Codebook, scale: float = SCALE) -> DataFrame:
    """``embedding``, the entries that each row's code names, divided by the scale (an approximation of the vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(batch.num_rows, len(book))
            x = np.concatenate([entries[numbers[:, p]] for p, entries in enumerate(book)], axis=1) / scale
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(list(x), pa.list_(pa.float64()))], ["vec_id", "embedding"])

    return coded.select("vec_id", "code").mapInArrow(run, "vec_id long, embedding array<double>")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add ``label_error``, the errors of all rows of the same label. Its table has one row for each label."""
    sums = stored(coded.groupBy(F.col("label").alias("_of")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_of")), "left").drop("_of")
