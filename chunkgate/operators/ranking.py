"""Exact row numbers without one big sorted partition."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkgate.functions.keys import hash32

MIN_BUCKETS, MAX_BUCKETS = 256, 65536
#: Rows in the sample that a cut comes from, on average.
ROWS_PER_CUT = 20


def n_buckets(df: DataFrame, per_partition: int = 2) -> int:
    """A power of two that follows the session's shuffle partitions, between fixed bounds.

    The upper bound keeps tables with one row for each bucket small enough to broadcast.
    """
    wanted = per_partition * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_BUCKETS, max(MIN_BUCKETS, 1 << (wanted - 1).bit_length()))


def cut_points(df: DataFrame, column: str, n_cuts: int | None = None) -> list[float]:
    """At most ``n_cuts`` increasing values that split the column about evenly.

    They only set the bucket sizes; the ranks built on them are exact. So they come from
    a sample whose expected size depends on the number of cuts alone: what reaches the
    one task that merges it does not grow with the table.
    """
    n_cuts = n_cuts or min(n_buckets(df), 16384) - 1
    value = F.col(column).cast("double")
    shares = [(i + 1) / (n_cuts + 1) for i in range(n_cuts)]
    values = df.filter(value.isNotNull() & ~F.isnan(value)).select(column)
    share = ROWS_PER_CUT * n_cuts / max(1, values.count())
    row = (values.sample(share, seed=n_cuts) if share < 1 else values).agg(F.percentile_approx(value, shares, 4 * n_cuts).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def with_range_bucket(df: DataFrame, column: str, cuts: Sequence[float], bucket: str = "_bucket") -> DataFrame:
    """Add the range bucket of a numeric column: a binary search over the cuts.

    Nulls have a bucket of their own before the others, NaN one after them.
    """
    number = df.withColumn("_value", F.col(column).cast("double"))
    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="_value", outputCol="_raw", handleInvalid="keep").transform(number)
    return bucketed.withColumn(bucket, F.coalesce(F.col("_raw").cast("int"), F.lit(-1))).drop("_value", "_raw")


def with_hash_bucket(df: DataFrame, row_id: str, seed: int, bucket: str = "_bucket") -> DataFrame:
    """Add a uniform bucket and the order ``_hash`` of a seeded shuffle of the rows; a null id counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(row_id).cast("string"), F.lit("")))
    hashed = df.withColumn("_hash", F.md5(text))
    return hashed.withColumn(bucket, F.floor(hash32(text) / (2**32 // n_buckets(df, 16))).cast("int"))


def bucket_offsets(bucketed: DataFrame, by: Sequence[str] = (), bucket: str = "_bucket") -> DataFrame:
    """Rows in each bucket and rows in all buckets before it, per group.

    A group has at most as many rows here as there are buckets, so the running sum
    sorts a bounded table.
    """
    counts = bucketed.groupBy(*by, bucket).agg(F.count("*").alias("_count"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_offset", F.coalesce(F.sum("_count").over(before), F.lit(0)))


def with_row_number(
    bucketed: DataFrame,
    order_by: Sequence[str],
    by: Sequence[str] = (),
    bucket: str = "_bucket",
    name: str = "row_number",
) -> DataFrame:
    """Add the 1-based row number in each group.

    Buckets must follow the order. Rows are sorted bucket by bucket and the counts of
    the earlier buckets are added, so a group that holds a third of the data is
    still spread over its buckets. A null group is a group like any other.
    """
    keys = [*by, bucket]
    offsets = bucket_offsets(bucketed, by, bucket).drop("_count").withColumnsRenamed({c: f"_of_{c}" for c in keys})
    if not by:
        offsets = F.broadcast(offsets)  # one row for each bucket
    inside = Window.partitionBy(*by, bucket).orderBy(*order_by)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys])
    joined = bucketed.join(offsets, same).drop(*[f"_of_{c}" for c in keys])
    return joined.withColumn(name, F.col("_offset") + F.row_number().over(inside)).drop("_offset", bucket)
