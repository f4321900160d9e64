"""Identities of data sets and of run parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, WORD_DIGITS, LANE_BITS = 4, 15, 20


def _lanes(word: Column) -> list[Column]:
    """A 60-bit word as three 20-bit numbers, high to low."""
    mask = F.lit((1 << LANE_BITS) - 1)
    return [F.shiftright(word, shift).bitwiseAND(mask) for shift in (2 * LANE_BITS, LANE_BITS, 0)]


def content_digest(valid: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Identity of a set of distinct keys, whatever its order, chunks or partitions.

    The first 240 bits of each key's SHA-256 are cut into twelve 20-bit numbers that are
    added up over the set; the digest is the SHA-256 of the row count and the sums. The
    sums combine on the map side, so no keys are shuffled, gathered or sorted, and they
    stay exact in a bigint for 2^43 rows.
    """
    digest = F.sha2(key, 256)
    words = [
        F.conv(F.substring(digest, 1 + WORD_DIGITS * i, WORD_DIGITS), 16, 10).cast("bigint").alias(f"_w{i}")
        for i in range(WORDS)
    ]
    lanes = [lane for i in range(WORDS) for lane in _lanes(F.col(f"_w{i}"))]
    sums = [F.sum(lane).alias(f"_s{i}") for i, lane in enumerate(lanes)]
    totals = valid.select(*by, *words).groupBy(*by).agg(F.count("*").alias("n_keys"), *sums)
    parts = [F.coalesce(f"_s{i}", F.lit(0)) for i in range(len(sums))]
    return totals.select(
        *by, "n_keys", F.sha2(F.concat_ws(":", "n_keys", *parts), 256).alias("content_digest")
    )


def params_hash(params: Column) -> Column:
    """SHA-256 of a string map's entries in key order."""
    entries = F.transform(
        F.array_sort(F.map_entries(params)),
        lambda e: F.concat(F.to_json(F.struct(e["key"].alias("k"), e["value"].alias("v")))),
    )
    return F.sha2(F.array_join(entries, ","), 256)
