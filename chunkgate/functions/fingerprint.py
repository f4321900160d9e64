"""Hashed neighbourhood fingerprints of token sequences."""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# A token's identifier is its hash modulo the prime; a round mixes it with its two
# neighbours' identifiers. The factors keep the sum of three products in a bigint.
PRIME = 2**31 - 1
LEFT, SELF, RIGHT, STEP = 363118201, 488117773, 252790403, 104729


#: Tokens whose rounds are worked out together, and cells of the table of rows and bits that they fill.
SLICE_TOKENS, SLICE_CELLS = 1 << 18, 1 << 24


def _hashed(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each token's identifier, 0 for a null, and which are null. A token that repeats is hashed once."""
    coded = tokens.dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    ids = np.fromiter((int.from_bytes(md5(w).digest()[:4], "big") % PRIME for w in words), np.int64, len(words))
    return np.append(ids, 0)[coded.indices.fill_null(len(words)).to_numpy(zero_copy_only=False)], coded.is_null().to_numpy(zero_copy_only=False)


def _next_round(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, r: int) -> np.ndarray:
    """Every position's identifier at radius r, from those at radius r - 1; lists lie from ``starts`` to ``ends``."""
    left, right = np.zeros_like(ids), np.zeros_like(ids)
    left[1:], right[:-1] = ids[:-1], ids[1:]
    left[starts], right[ends - 1] = 0, 0
    return (left * LEFT + ids * SELF + right * RIGHT + r * STEP) % PRIME


def _bits_of(ids: np.ndarray, null: np.ndarray, sizes: np.ndarray, radius: int, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bit of the distinct on-bits of some lists, in order; ``n_bits`` stands for null, which is last."""
    ends = np.cumsum(sizes)[sizes > 0]
    starts = ends - sizes[sizes > 0]
    row = np.repeat(np.arange(len(sizes)), sizes)
    width = n_bits + 1
    found = []
    for r in range(radius + 1):
        if r:
            ids = _next_round(ids, starts, ends, r)
            ids[null] = 0
        found.append(row * width + np.where(null, n_bits, ids % n_bits))
    if len(sizes) * width <= 2 * SLICE_CELLS:
        on = np.zeros(len(sizes) * width, bool)
        for cells in found:
            on[cells] = True
        cells = np.flatnonzero(on)
    else:
        cells = np.unique(np.concatenate(found))
    return cells // width, cells % width


def _bits(tokens: pa.Array, radius: int, n_bits: int) -> pa.Array:
    sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ids, null = _hashed(tokens.flatten())
    ends = np.cumsum(sizes)
    most_rows = max(1, SLICE_CELLS // (n_bits + 1))
    counts, bits, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], 0
    while at < len(sizes):
        base = int(ends[at - 1]) if at else 0
        to = min(max(at + 1, int(np.searchsorted(ends, base + SLICE_TOKENS, "right"))), at + most_rows)
        part = slice(base, int(ends[to - 1]))
        row, bit = _bits_of(ids[part], null[part], sizes[at:to], radius, n_bits)
        counts.append(np.bincount(row, minlength=to - at))
        bits.append(bit.astype(np.int32))
        at = to
    values = np.concatenate(bits)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
    absent = tokens.is_null() if tokens.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, mask=values == n_bits), mask=absent)


def fingerprint_bits(tokens: Column, radius: int, n_bits: int) -> Column:
    """Sorted distinct on-bits: one for each position and radius 0..radius.

    The identifier of a position at radius r depends on the tokens i-r..i+r, absent
    ones counting as 0. All of it is row-local, so no document leaves its partition;
    the rounds run over the tokens of many rows at once.
    """
    if radius < 0 or n_bits <= 0:
        raise ValueError("radius cannot be negative, nor n_bits below 1")

    def bits(lists: pa.Array) -> pa.Array:
        return _bits(lists, radius, n_bits)

    return F.arrow_udf(bits, "array<int>")(tokens)
