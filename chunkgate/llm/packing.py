"""Packing documents into sequences without changing their order, by dynamic programming.

Ids of a task's documents form one stream. Cuts are allowed at ends of documents, after sentences
and, where a sentence is long, inside it. ``f(i)`` is the least cost of a stream that ends at cut
place i: padding of its sequences plus a penalty for each cut inside a document. The best previous
cut lies at most one sequence back, so a monotone queue of ``f(j) + place(j)`` gives it in constant
time. The stream is packed in blocks of bounded size; the last, unfinished sequence of a block
begins the next. What a task has left at its end is cut into powers of two, which need no padding.

Defined results: documents keep the order of the table's files and rows, nulls are empty texts,
repeated rows are packed each by itself, extra columns are ignored, an empty table has no pieces. A
text without ids and without end id has no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.llm.tokens import encoder, with_end
from chunkgate.llm.words import slices

LENGTH = 2048
#: Costs of a cut after a sentence and inside one, in ids of padding.
SENTENCE_CUT, HARD_CUT = 4, 16
#: In longer sentences there is a place to cut after each so many ids.
HARD_STEP = 32
#: Ids that are packed together.
BLOCK_IDS = 1 << 18
#: Bytes of text whose words are held as Python strings at a time.
TEXT_BYTES = 1 << 20
#: Bits of sequence_id for the number inside a task.
TASK_BITS = 40


def cut_places(n: int, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a stream of n ids may be cut, from 0 to n, and what a cut there costs."""
    cost = np.full(n + 1, -1, np.int32)
    cost[sentence_ends] = SENTENCE_CUT
    cost[doc_ends] = 0
    cost[[0, n]] = 0
    places = np.flatnonzero(cost >= 0)
    gaps = np.diff(places)
    long = np.flatnonzero(gaps > HARD_STEP)
    more = (gaps[long] - 1) // HARD_STEP
    step = np.arange(1, more.sum() + 1) - np.repeat(np.cumsum(more) - more, more)
    cost[np.repeat(places[long], more) + step * HARD_STEP] = HARD_CUT
    places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def best_cuts(places: np.ndarray, cost: np.ndarray, length: int) -> list[int]:
    """The places of the cheapest cuts, both ends included."""
    at, pay = places.tolist(), cost.tolist()
    value, back = [0] * len(at), [0] * len(at)
    queue, first = [0], 0  # the queue begins at ``first``
    last = np.searchsorted(places, places - length).tolist()  # the earliest place that is near enough
    for i in range(1, len(at)):
        least = last[i]
        while queue[first] < least:
            first += 1
        j = queue[first]
        back[i] = j
        v = value[j] + length + pay[i]  # the padding's "- here" and the next "+ here" cancel
        value[i] = v
        while value[queue[-1]] >= v:  # never past j, whose value is less
            queue.pop()
        queue.append(i)
    cuts, i = [at[-1]], len(at) - 1
    while i:
        i = back[i]
        cuts.append(at[i])
    return cuts[::-1]


def powers(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(documents: DataFrame, vocabulary: str, end: int | None, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents. ``with_ids`` adds each piece's ids, little-endian unsigned 32-bit.

    One pass over the table, no shuffle: a task packs the documents it reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        base, made = TaskContext.get().partitionId() << TASK_BITS, 0
        # The stream so far: ids, and for each document its id, whether that is null, its size and where it began.
        stream: list[np.ndarray] = []
        docs: list[tuple] = []
        held = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal stream, docs, held, made
            ids = np.concatenate(stream) if stream else np.zeros(0, np.uint32)
            keys, nulls, sizes, begins = (np.concatenate([d[k] for d in docs]) for k in range(4))
            ends = begins + sizes
            inside = ends[(ends > 0) & (ends <= len(ids))]
            cuts = best_cuts(*cut_places(len(ids), inside, np.flatnonzero(code.ends_sentence[ids]) + 1), length) if len(ids) else [0]
            if len(cuts) > 1 and cuts[-1] - cuts[-2] < length:
                rest = cuts.pop() - cuts[-1]
                if last:
                    for p in powers(rest):
                        cuts.append(cuts[-1] + p)
            done = cuts[-1]
            if done:
                edges = np.array(cuts)
                marks = np.unique(np.concatenate([edges, inside[inside < done]]))
                lo, hi = marks[:-1], marks[1:]
                # Documents without ids share their place with the next; the last that begins there has them.
                doc = np.searchsorted(begins, lo, "right") - 1
                seq = np.searchsorted(edges, lo, "right") - 1
                raw = ids.astype("<u4")
                arrays = [
                    pa.array(keys[doc], mask=nulls[doc]), pa.array(lo - begins[doc]), pa.array(hi - lo),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in zip(lo, hi)], pa.int64()),
                    pa.array(sizes[doc]), pa.array(base + made + seq), pa.array(lo - edges[seq]),
                ]
                if with_ids:
                    arrays.append(pa.array([raw[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names)
                made += len(cuts) - 1
            open_ = ends > done
            stream, held = [ids[done:]], len(ids) - done
            docs = [(keys[open_], nulls[open_], sizes[open_], begins[open_] - done)]

        for batch in batches:
            for block in slices(batch, "text"):
                for rows in slices(block, "text", TEXT_BYTES):
                    ids, sizes = with_end(*code.encode(rows.column("text").to_pylist()), end)
                    key = rows.column("doc_id").cast(pa.int64())
                    stream.append(ids)
                    docs.append((
                        key.fill_null(0).to_numpy(zero_copy_only=False), key.is_null().to_numpy(zero_copy_only=False),
                        sizes, held + np.cumsum(sizes) - sizes,
                    ))
                    held += len(ids)
                if held >= BLOCK_IDS:
                    yield from flush(False)
        if docs:
            yield from flush(True)

    names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES + ", ids binary" * with_ids)
