"""Joins whose left side may hold a third of its rows under one key.

A join against a table of one row for each group (fitted lines, champions) takes that
table stored: Spark then knows its size and broadcasts a small one, and for a large one
splits hot partitions as below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 2048
SALTS = 64


def key_set(df: DataFrame, key: str) -> DataFrame:
    """The keys of a table for a semi or anti join, each at most SALTS times.

    Repeats are collapsed by key and salt, so that a hot key is spread over the tasks.
    The join then shuffles this set itself instead of taking over the grouping's
    shuffle, and adaptive execution can split a hot partition of the other side: it
    does so only for a join that reads both sides straight from a shuffle.
    """
    salted = df.select(key).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return salted.distinct().select(key)


def hot_keys(df: DataFrame, key: str, counts: str | None = None) -> DataFrame:
    """The most frequent keys, at most HOT_KEYS rows whatever the input holds.

    Every other key has fewer than 1/HOT_KEYS of the rows. ``df`` may already hold
    one row for each key with its number of rows in ``counts``.
    """
    if counts is None:
        counts = "_n"
        df = df.groupBy(key).agg(F.count("*").alias(counts))
    return df.orderBy(F.desc(counts), key).limit(HOT_KEYS).select(key, F.lit(SALTS).alias("_salts"))


def spread_join(
    rows: DataFrame, unique: DataFrame, key: str, row_id: str, how: str, counts: str | None = None
) -> DataFrame:
    """Join rows with a table of unique keys, hot keys spread over SALTS tasks.

    The hot-key list is bounded by HOT_KEYS, hence the broadcast on both sides.
    Only hot keys are repeated on the unique side, so it grows by at most
    HOT_KEYS * SALTS rows; the join itself stays an ordinary equi-join.
    ``counts`` names the column of ``unique`` that says how many rows a key has,
    which saves counting them again.
    """
    hot = F.broadcast(hot_keys(rows, key) if counts is None else hot_keys(unique, key, counts))
    salted_rows = rows.join(hot, key, "left").withColumn(
        "_salt",
        F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int")
        ),
    )
    salted_unique = (
        unique.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return salted_rows.drop("_salts").join(salted_unique, [key, "_salt"], how).drop("_salt")
