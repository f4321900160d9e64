"""Exact interpolated quantiles by distributed selection."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkgate.operators.ranking import cut_points, with_range_bucket


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation, ignoring null and NaN.

    Approximate cuts split the values into ranges, at most 16,384. One count for
    each range tells which ranges hold the wanted order statistics, and only the
    values of those few ranges are grouped and sorted. Equal values are counted
    before they meet, so one value may hold any share of the rows.
    """
    number = F.col(column).cast("double")
    values = df.select(number.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    bucketed = with_range_bucket(values, "_x", cut_points(values, "_x"))
    sizes = {r["_bucket"]: r["n"] for r in bucketed.groupBy("_bucket").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return [None] * len(shares)

    offsets, seen = {}, 0
    for bucket in sorted(sizes):
        offsets[bucket], seen = seen, seen + sizes[bucket]
    positions = [(total - 1) * share for share in shares]
    ranks = sorted({r for p in positions for r in (math.floor(p), math.ceil(p))})
    home = {r: max(b for b in offsets if offsets[b] <= r) for r in ranks}

    wanted = bucketed.filter(F.col("_bucket").isin(sorted(set(home.values()))))
    counted = wanted.groupBy("_bucket", "_x").agg(F.count("*").alias("_n"))
    running = F.sum("_n").over(Window.partitionBy("_bucket").orderBy("_x"))
    ordered = counted.withColumn("_upto", running)
    picks = [
        F.min(F.when((F.col("_bucket") == home[r]) & (F.col("_upto") > r - offsets[home[r]]), F.col("_x"))).alias(
            f"r{i}"
        )
        for i, r in enumerate(ranks)
    ]
    found = dict(zip(ranks, ordered.agg(*picks).first()))
    out = []
    for p in positions:
        low, high = found[math.floor(p)], found[math.ceil(p)]
        out.append(low if low == high else low + (high - low) * (p - math.floor(p)))
    return out
