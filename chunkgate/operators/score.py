"""Ranked shortlists of scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkgate import defaults


def predicted_name(target: str) -> str:
    return f"predicted_{target}"


def _ranking(df: DataFrame, prediction: str, key: str, ascending: bool) -> list[Column]:
    """Null and NaN predictions come last in either direction; the key breaks ties."""
    value = F.col(prediction)
    if isinstance(df.schema[prediction].dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    return [value.asc_nulls_last() if ascending else value.desc_nulls_last(), F.col(key).asc()]


def shortlist(
    scored: DataFrame,
    prediction: str,
    key: str,
    size: int = defaults.SHORTLIST_SIZE,
    ascending: bool = defaults.RANK_ASCENDING,
) -> DataFrame:
    """The best ``size`` rows; each task sends on only its own best ``size``."""
    if size < 1:
        raise ValueError("size cannot be below 1")
    return scored.orderBy(*_ranking(scored, prediction, key, ascending)).limit(size)


def shortlist_head(ranked: DataFrame, prediction: str, key: str, n: int = 10, ascending: bool = True) -> DataFrame:
    """Key and prediction of the first rows of a shortlist, for display."""
    return ranked.orderBy(*_ranking(ranked, prediction, key, ascending)).limit(n).select(key, prediction)


def shortlist_by_segment(
    scored: DataFrame,
    segment: Sequence[str],
    prediction: str,
    key: str,
    size: int = defaults.SHORTLIST_SIZE,
    ascending: bool = defaults.RANK_ASCENDING,
) -> DataFrame:
    """The best ``size`` rows of each segment, with their ``rank``.

    Spark applies the rank limit in each task before the shuffle, so a hot segment
    reaches its reducer as ``size`` rows from each task.
    """
    order = Window.partitionBy(*segment).orderBy(*_ranking(scored, prediction, key, ascending))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
