"""Profiles of a chunk: nulls, spreads, summaries, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkgate.functions.keys import compact_key
from chunkgate.operators.quantiles import exact_quantiles


#: Registers of a key sketch, as a power of two: a standard error of about 0.4 % in 64 KB.
SKETCH_PRECISION = 16


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def distinct_keys(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(F.count(key).alias("n_keys"), count(compact_key(F.col(key))).alias("distinct_keys"))


def given(df: DataFrame, column: str) -> Column:
    """The column with NaN as null."""
    value = F.col(column)
    return F.when(~F.isnan(value), value) if isinstance(df.schema[column].dataType, T.FractionalType) else value


def dup_spread(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Max minus min of each column within every repeated key; null keys repeat nothing, NaN spreads nothing."""
    spreads = [(F.max(given(df, c)) - F.min(given(df, c))).alias(c) for c in columns]
    keyed = df.filter(F.col(key).isNotNull())
    groups = keyed.groupBy(compact_key(F.col(key)).alias("_compact")).agg(F.min(key).alias(key), F.count("*").alias("copies"), *spreads)
    return groups.filter(F.col("copies") > 1).drop("_compact")


def long_form(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Turn a one-row summary into one row for each column."""
    return row.unpivot([], list(columns), name, value)


def max_dup_spread(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Largest spread of each column over all repeated keys, largest first."""
    widest = dup_spread(df, key, columns).agg(*[F.max(c).cast("double").alias(c) for c in columns])
    return long_form(widest, columns, "column_name", "max_spread").orderBy(F.desc("max_spread"), "column_name")


def null_profile(df: DataFrame) -> DataFrame:
    """Type and number of nulls of each column, from one scan."""
    counts = df.agg(*[F.count_if(given(df, c).isNull()).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    return long_form(counts, df.columns, "column_name", "null_rows").withColumn(
        "column_type", types[F.col("column_name")]
    )


def describe_target(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum as numbers."""
    q25, q50, q75 = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    value = F.col(column).cast("double")
    present = df.filter(value.isNotNull() & ~F.isnan(value))
    return present.agg(
        F.count("*").alias("n_rows"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).select(
        "n_rows", "mean", "std", "min",
        F.lit(q25).cast("double").alias("q25"),
        F.lit(q50).cast("double").alias("q50"),
        F.lit(q75).cast("double").alias("q75"),
        "max",
    )


def quantile_table(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Exact quantiles of several columns, one row for each column and share."""
    rows = [
        (c, float(share), value)
        for c in columns
        for share, value in zip(shares, exact_quantiles(df, c, shares))
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, share double, value double")


def histogram(df: DataFrame, column: str, bins: int = 80) -> DataFrame:
    """Rows in each of ``bins`` equal ranges between minimum and maximum; empty ones show 0."""
    value = F.col(column).cast("double")
    present = df.select(value.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    bounds = present.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("b")).scalar()
    placed = present.withColumn("_b", bounds)
    width = (F.col("_b.hi") - F.col("_b.lo")) / bins
    position = F.floor((F.col("_x") - F.col("_b.lo")) / F.nullif(width, F.lit(0.0)))
    counted = placed.groupBy(F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).alias("bin")).agg(
        F.count("*").alias("n_rows")
    )
    every = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return every.join(counted, "bin", "left").select("bin", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def mean_abs_ranked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean magnitude of each column without its nulls and NaN, largest first."""
    means = df.agg(*[F.avg(F.abs(given(df, c).cast("double"))).alias(c) for c in columns])
    return long_form(means, columns, "column_name", "mean_abs").orderBy(F.desc("mean_abs"), "column_name")


def key_sketches(df: DataFrame, key: str, by: Sequence[str] = (), precision: int = SKETCH_PRECISION) -> DataFrame:
    """A sketch of the distinct keys of each chunk, to be stored: 2^precision registers, whatever the chunk's size."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(key, F.lit(precision)).alias("sketch"))


def sketched_keys(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct keys of the union of the sketched chunks (for each group), without their keys."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, F.hll_sketch_estimate("sketch").alias("n_keys"))


def sketched_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: distinct keys of two sketched sides, of both together, and those that both have."""
    sides = left.select("sketch", F.lit(True).alias("l")).unionByName(right.select("sketch", F.lit(False).alias("l")))
    union = sides.groupBy().agg(
        F.hll_union_agg(F.when(F.col("l"), F.col("sketch"))).alias("a"), F.hll_union_agg(F.when(~F.col("l"), F.col("sketch"))).alias("b"), F.hll_union_agg("sketch").alias("ab")
    )
    a, b, ab = (F.coalesce(F.hll_sketch_estimate(c), F.lit(0)) for c in ("a", "b", "ab"))
    return union.select(a.alias("left_keys"), b.alias("right_keys"), ab.alias("all_keys"), F.greatest(a + b - ab, F.lit(0)).alias("shared_keys"))
