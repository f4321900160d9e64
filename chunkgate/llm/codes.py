"""Token ids in directly addressable codes.

An id is cut into chunks of a few bits. Level 0 holds the lowest chunk of every id, level k the next
chunk of the ids that go on; a bitmap for each level says which do, and a rank directory (set bits
before each 512th) finds an id's place on the next level. Any id is read by two or three lookups,
without decoding its neighbours.

A file holds some consecutive documents: header, document table, then level after level. Files are
the ``data`` of rows written as Parquet, so that any store that Spark writes to can hold them and a
lost task leaves no half file. ``part`` and ``seq`` order the files by ascending doc_id.

Defined results: a null or empty text has only the end id. Null ids come first. Documents with equal
ids stand side by side, each with ids of its own; which of them is first is not defined. Extra
columns are ignored. An empty table gives no files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkgate.llm.tokens import encoder, with_end
from chunkgate.llm.words import slices

#: A file is closed by the first document that brings it to so many ids.
FILE_IDS = 1 << 20
CHUNK_BITS = 8
_RANK = 512
_HEAD = struct.Struct("<4sHHQQ")
_MAGIC = b"DAC1"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack_file(ids: np.ndarray, doc_ids: np.ndarray, null_ids: np.ndarray, counts: np.ndarray, bits: int = CHUNK_BITS) -> bytes:
    """One file. ``bits`` (8 or 16) is the width of a chunk."""
    kind = {8: "<u1", 16: "<u2"}[bits]
    parts, rest = [], ids.astype(np.uint32)
    while True:
        goes_on = rest >> np.uint32(bits) != 0
        bitmap = np.packbits(goes_on, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(_ONES[bitmap], dtype=np.uint64)])[:: _RANK // 8].astype("<u4")
        parts += [struct.pack("<Q", len(rest)), (rest & np.uint32((1 << bits) - 1)).astype(kind).tobytes(), bitmap.tobytes(), ranks.tobytes()]
        rest = rest[goes_on] >> np.uint32(bits)
        if not len(rest):
            break
    table = [doc_ids.astype("<i8").tobytes(), null_ids.astype("<u1").tobytes(), counts.astype("<i8").tobytes()]
    return b"".join([_HEAD.pack(_MAGIC, bits, len(parts) // 4, len(doc_ids), len(ids)), *table, *parts])


class CodeFile:
    """Reads a file: its documents, single ids by position, or all of them."""

    def __init__(self, data: bytes) -> None:
        magic, self.bits, levels, n_docs, self.n_ids = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a file of token ids")
        at = _HEAD.size

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.null_ids, self.counts = read("<i8", n_docs), read("<u1", n_docs).astype(bool), read("<i8", n_docs)
        self.levels = []
        for _ in range(levels):
            n = int(read("<u8", 1)[0])
            low, bitmap = read({8: "<u1", 16: "<u2"}[self.bits], n), read("<u1", (n + 7) // 8)
            self.levels.append((low, bitmap, read("<u4", len(range(0, len(bitmap) + 1, _RANK // 8)))))

    def ids_at(self, positions: np.ndarray) -> np.ndarray:
        """Ids at positions of the file, by ranks alone."""
        at = np.asarray(positions, np.int64)
        out, todo = np.zeros(len(at), np.uint32), np.arange(len(at))
        for k, (low, bitmap, ranks) in enumerate(self.levels):
            out[todo] |= low[at].astype(np.uint32) << np.uint32(self.bits * k)
            byte, bit = at >> 3, at & 7
            on = (bitmap[byte] >> bit.astype(np.uint8)) & 1 == 1
            todo, at, byte, bit = todo[on], at[on], byte[on], bit[on]
            if not len(todo):
                break
            block = at // _RANK
            rank = ranks[block].astype(np.int64) + _ONES[bitmap[byte] & ((1 << bit) - 1).astype(np.uint8)]
            first = block * (_RANK // 8)
            for step in range(_RANK // 8):
                inside = first + step < byte
                if not inside.any():
                    break
                rank[inside] += _ONES[bitmap[(first + step)[inside]]]
            at = rank
        return out

    def all_ids(self) -> np.ndarray:
        """Every id, level by level from the highest."""
        rest = np.zeros(0, np.uint32)
        for low, bitmap, _ in reversed(self.levels):
            own = low.astype(np.uint32)
            on = np.unpackbits(bitmap, count=len(low), bitorder="little").astype(bool)
            own[on] |= rest << np.uint32(self.bits)
            rest = own
        return rest


FILES = "part int, seq int, first_doc long, n_docs long, n_ids long, data binary"


def encode_files(documents: DataFrame, vocabulary: str, end: int | None, bits: int = CHUNK_BITS, file_ids: int = FILE_IDS) -> DataFrame:
    """Files of the ids of all texts, in ascending doc_id order.

    Texts are range-partitioned by doc_id, so a task holds neighbouring documents and no task more
    than its share; the library encodes inside the task.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            nonlocal seq
            ids, docs, nulls, counts = (np.concatenate([x[k] for x in held]) for k in range(4))
            row = {"part": part, "seq": seq, "first_doc": None if nulls[0] else int(docs[0]), "n_docs": len(docs), "n_ids": len(ids)}
            seq += 1
            held.clear()
            out = pa.RecordBatch.from_pylist([row | {"data": pack_file(ids, docs, nulls, counts, bits)}], schema=_FILES)
            return out

        for batch in batches:
            for rows in slices(batch, "text"):
                ids, counts = with_end(*encoder(vocabulary).encode(rows.column("text").to_pylist()), end)
                docs = rows.column("doc_id").cast(pa.int64())
                held.append((ids, docs.fill_null(0).to_numpy(zero_copy_only=False), docs.is_null().to_numpy(zero_copy_only=False), counts))
                if sum(len(x[0]) for x in held) >= file_ids:
                    yield close()
        if held:
            yield close()

    ordered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(write, FILES)


_FILES = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])


def file_starts(files: DataFrame) -> DataFrame:
    """part, seq and the number of ids in all files before: sums for each part, then inside each part."""
    own = files.select("part", "seq", "n_ids")
    parts = own.groupBy("part").agg(F.sum("n_ids").alias("all"))  # one row for each writing task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return own.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("base") + F.col("inside")).alias("base")
    )


def read_documents(files: DataFrame) -> DataFrame:
    """One row for each document, decoded from its file: doc_id, start, n_tokens, ids_crc32, and where it lies."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = CodeFile(row["data"])
                ids = file.all_ids().astype("<u4")
                ends = np.cumsum(file.counts)
                begins = ends - file.counts
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["seq"], np.int32)),
                        pa.array(file.doc_ids, mask=file.null_ids), pa.array(begins), pa.array(file.counts),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in zip(begins, ends)], pa.int64()),
                    ],
                    ["part", "seq", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )

    rows = files.select("part", "seq", "data").mapInArrow(decode, "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    return rows.join(file_starts(files), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "part", "seq", "local_start"
    )


def read_ids(files: DataFrame, positions: DataFrame) -> DataFrame:
    """The ids at (part, seq, position): each file that is asked for is opened once, nothing is decoded."""
    asked = positions.groupBy("part", "seq").agg(F.collect_list("position").alias("positions"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = np.array(row["positions"], np.int64)
                yield pa.RecordBatch.from_pydict({
                    "part": np.full(len(at), row["part"], np.int32), "seq": np.full(len(at), row["seq"], np.int32),
                    "position": at, "id": CodeFile(row["data"]).ids_at(at).astype(np.int64),
                })

    return files.select("part", "seq", "data").join(asked, ["part", "seq"]).mapInArrow(look_up, "part int, seq int, position long, id long")


def write_files(documents: DataFrame, path: str, vocabulary: str, end: int | None, **options) -> DataFrame:
    """Write the files to a shared folder and return them as read from there."""
    encode_files(documents, vocabulary, end, **options).write.option("compression", "none").parquet(path)
    return open_files(documents.sparkSession, path)


def open_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILES).parquet(path)
