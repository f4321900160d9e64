"""Exact-size samples, disjoint halves and consecutive slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkgate import defaults
from chunkgate.operators.ranking import (
    bucket_offsets,
    cut_points,
    with_hash_bucket,
    with_range_bucket,
    with_row_number,
)


def seeded_sample(df: DataFrame, row_id: str, n: int, seed: int = defaults.SPLIT_SEED) -> DataFrame:
    """Exactly n rows (or all, if fewer), the same ones on every run and partitioning.

    The n smallest seeded hashes win. ``row_id`` must be unique. Buckets that lie
    wholly inside the sample pass unsorted, buckets outside it are dropped before
    any shuffle, and only the one bucket on the border is ranked.
    """
    if n < 1:
        raise ValueError("n cannot be below 1")
    bucketed = with_hash_bucket(df, row_id, seed)
    offsets = bucket_offsets(bucketed).filter(F.col("_offset") < n)
    placed = bucketed.join(F.broadcast(offsets), "_bucket")
    inside = placed.filter(F.col("_offset") + F.col("_count") <= n)
    border = placed.filter(F.col("_offset") + F.col("_count") > n)
    order = Window.partitionBy("_bucket").orderBy("_hash", row_id)
    ranked = border.withColumn("_rank", F.row_number().over(order))
    chosen = ranked.filter(F.col("_rank") <= F.lit(n) - F.col("_offset"))
    return inside.select(df.columns).unionByName(chosen.select(df.columns))


def disjoint_halves(
    df: DataFrame, row_id: str, n: int, seed: int = defaults.SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint samples of n rows each, cut from one sample of 2n."""
    sample = seeded_sample(df, row_id, 2 * n, seed)
    ranked = with_row_number(with_hash_bucket(sample, row_id, seed), ["_hash", row_id]).drop("_hash")
    first = ranked.filter(F.col("row_number") <= n)
    second = ranked.filter(F.col("row_number") > n)
    return first.drop("row_number"), second.drop("row_number")


def sequential_chunks(df: DataFrame, order: str, chunk_rows: int) -> DataFrame:
    """Add ``chunk``: consecutive slices of ``chunk_rows`` rows in arrival order.

    ``order`` must be a unique number.
    """
    bucketed = with_range_bucket(df, order, cut_points(df, order))
    ranked = with_row_number(bucketed, [order])
    chunk = F.floor((F.col("row_number") - 1) / chunk_rows).cast("bigint")
    return ranked.withColumn("chunk", chunk).drop("row_number")
