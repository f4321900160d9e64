"""Words of whole texts as flat numpy arrays, straight from Arrow buffers.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return. All words of a slice of rows lie in the same arrays, so that hashing,
windows and counts are array operations and no Python object is made for a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANKS = (9, 10, 11, 12, 13, 32)
IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS)] = True

#: Rows are handled in slices of about so many bytes of text; one longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: And of at most so many rows.
SLICE_ROWS = 4000

_U = np.uint64
_LONG = 64
_LOW = np.array([0, *[(1 << (8 * k)) - 1 for k in range(1, 9)]], dtype=_U)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (in place): a bijection, so equal in means equal out and back."""
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One name for each ordered pair of names."""
    return mix(a * _U(0x9E3779B97F4A7C15) + (b ^ (b >> _U(29))) * _U(0xC2B2AE3D27D4EB4F) + _U(1))


@dataclass
class Words:
    """Words of some rows: bytes ``start``..``end`` of ``data``; row r has words ``first[r]``..``first[r + 1]``."""

    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sum over each row of a value for each byte of data."""
        return at_bounds(flags, self.bounds)


def at_bounds(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends; null is an empty text."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8)[bounds[0] : bounds[-1]] if whole is not None and len(whole) else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def split_words(texts: pa.Array, is_blank: np.ndarray = IS_BLANK) -> Words:
    data, bounds = text_bytes(texts)
    n = len(data)
    blank = is_blank[data]
    before, after = np.ones(n + 1, bool), np.ones(n + 1, bool)
    before[1:] = np.append(blank[:-1], True) if n else True
    after[:n] = np.append(blank[1:], True) if n else True
    before[bounds[:-1]] = True
    after[np.maximum(bounds[1:], 1) - 1] |= bounds[1:] > 0
    start = np.flatnonzero(~blank & before[:n])
    end = np.flatnonzero(~blank & after[:n]) + 1
    return Words(data, bounds, start, end, np.searchsorted(start, bounds))


def hash_words(words: Words, data: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit name of each word, the same in every task. ``data``: other bytes in place of the texts' own."""
    return hash_spans(words.data if data is None else data, words.start, words.end)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    length = end - start
    h = mix(length.astype(_U) + _U(0x51ED270B))
    for i in np.flatnonzero(length > _LONG):
        h[i] = int.from_bytes(hashlib.blake2b(padded[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    todo = np.flatnonzero(length <= _LONG)
    at, left = start[todo], length[todo]
    while len(todo):
        part = eight[at] & _LOW[np.minimum(left, 8)]
        h[todo] = mix(h[todo] * _U(3) ^ part)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return h


def windows(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all windows of n words that lie in one row, and the word at which each begins."""
    names, power, size, at, bits = None, h, 1, 0, n
    while bits:  # n as a sum of powers of two, whose names come from doubling
        if bits & 1:
            tail = power[at:]
            if names is None:
                names = tail
            else:
                k = min(len(names), len(tail))
                names = join(names[:k], tail[:k])
            at += size
        bits >>= 1
        if bits:
            power = join(power[: max(0, len(power) - size)], power[size:])
            size *= 2
    names = names[: max(0, len(h) - n + 1)]
    count = np.maximum(np.diff(first) - n + 1, 0)
    begin = first[:-1][count > 0]
    inside = np.zeros(len(h) + 1, np.int32)
    np.add.at(inside, begin, 1)
    np.add.at(inside, begin + count[count > 0], -1)
    where = np.flatnonzero(np.cumsum(inside[: len(h)]) > 0)
    return names[where], where


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces of bounded text."""
    sizes = np.diff(text_bytes(batch.column(column))[1])
    done = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = done[at - 1] if at else 0
        to = min(max(at + 1, int(np.searchsorted(done, base + max_bytes, "right"))), at + SLICE_ROWS)
        yield batch.slice(at, to - at)
        at = to


def sampled_texts(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, text and the label of ``sample`` (doc_id and a label), one row for each doc_id: the text with the smallest hash."""
    label = next(c for c in sample.columns if c != "doc_id")
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id", label).agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least"))
    return rows.select("doc_id", F.col("least.text").alias("text"), label)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each run of equal keys begins (and the end)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return order, np.append(begins, len(keys))
