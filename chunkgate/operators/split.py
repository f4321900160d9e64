"""Deterministic train / held-out split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate import defaults
from chunkgate.functions.keys import unit_hash


def with_split(
    df: DataFrame,
    key: str,
    fraction: float = defaults.TEST_FRACTION,
    seed: int = defaults.SPLIT_SEED,
) -> DataFrame:
    """Add ``is_test``. Membership depends on the key alone, so it never changes
    as chunks arrive or are repackaged."""
    if not 0 < fraction < 1:
        raise ValueError("fraction lies strictly between 0 and 1")
    return df.withColumn("is_test", unit_hash(seed, F.col(key)) < fraction)


def train_rows(split: DataFrame) -> DataFrame:
    return split.filter(~F.col("is_test")).drop("is_test")


def held_out_rows(split: DataFrame) -> DataFrame:
    return split.filter("is_test").drop("is_test")
