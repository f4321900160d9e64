"""Per-row errors, error summaries and the pairing of two models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def abs_error(prediction: str, target: str) -> Column:
    return F.abs(F.col(prediction) - F.col(target))


def mae(df: DataFrame, prediction: str, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Held-out rows and mean absolute error, overall or for each group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.avg(abs_error(prediction, target)).alias("mae")
    )


def paired_errors(candidate: DataFrame, champion: DataFrame, key: str) -> DataFrame:
    """Errors of two models on the same held-out rows, matched by key.

    Both tables hold ``key`` (unique) and ``abs_error``.
    """
    left = candidate.select(key, F.col("abs_error").alias("candidate_error"))
    right = champion.select(key, F.col("abs_error").alias("champion_error"))
    return left.join(right, key)


def require_paired(candidate: DataFrame, champion: DataFrame, key: str) -> None:
    """Raise unless both models were judged on exactly the same keys."""
    sides = candidate.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        champion.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_key = sides.groupBy(key).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    unmatched = per_key.filter((F.col("_l") != 1) | (F.col("_r") != 1)).agg(F.count("*")).first()[0]
    if unmatched:
        raise ValueError(f"{unmatched} held-out keys are not paired one to one")


def mae_delta(errors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Champion error minus candidate error: positive when the candidate is better."""
    return errors.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.avg("candidate_error").alias("candidate_mae"),
        F.avg("champion_error").alias("champion_mae"),
        (F.avg("champion_error") - F.avg("candidate_error")).alias("delta_observed"),
    )


def with_champion(candidates: DataFrame, champions: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every candidate with its champion if there is one; ``cold_start`` says there is none."""
    known = champions.withColumn("_known", F.lit(True))
    joined = candidates.join(known, list(on), "left")
    return joined.withColumn("cold_start", F.col("_known").isNull()).drop("_known")
