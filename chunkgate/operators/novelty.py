"""How new an incoming chunk is, and the rule that asks for a retrain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.functions.keys import Rule, canonical_key, compact_key
from chunkgate.operators.skew import key_set


def _known(df: DataFrame, key: str, canonical: bool, rule: Rule | None, all_rows: bool = False) -> DataFrame:
    """Rows with a key (or all), and its compact form ``_ck`` (computed once, see parsed_rows)."""
    value = canonical_key(df, key, rule) if canonical else F.col(key)
    explode = F.explode_outer if all_rows else F.explode
    return df.select("*", explode(F.array_compact(F.array(compact_key(value)))).alias("_ck"))


def known_keys(df: DataFrame, key: str, canonical: bool = False, rule: Rule | None = None, all_rows: bool = True, keep: bool = False) -> DataFrame:
    """The compact key ``_ck`` of each row (or of those that have one), beside the row if ``keep`` is set."""
    rows = _known(df, key, canonical, rule, all_rows)
    return rows if keep else rows.select("_ck")


def share_of(part: str, whole: str):
    """A share with four decimals, ties to even; of nothing it is 0."""
    return F.bround(F.col(part) / F.greatest(whole, F.lit(1)), 4)


def _split_rows(incoming, reference, key, how, canonical, rule):
    arrived = _known(incoming, key, canonical, rule)
    return arrived.join(key_set(_known(reference, key, canonical, rule), "_ck"), "_ck", how).drop("_ck")


def novel_rows(
    incoming: DataFrame,
    reference: DataFrame,
    key: str,
    canonical: bool = False,
    rule: Rule | None = None,
) -> DataFrame:
    """Incoming rows whose key the reference lacks; repeats count each time."""
    return _split_rows(incoming, reference, key, "left_anti", canonical, rule)


def known_rows(
    incoming: DataFrame,
    reference: DataFrame,
    key: str,
    canonical: bool = False,
    rule: Rule | None = None,
) -> DataFrame:
    """Incoming rows whose key the reference has."""
    return _split_rows(incoming, reference, key, "left_semi", canonical, rule)


def novelty_facts(
    incoming: DataFrame,
    reference: DataFrame,
    key: str,
    canonical: bool = False,
    rule: Rule | None = None,
) -> DataFrame:
    """One row: incoming rows, novel rows and their share, reference rows.

    Both sides are counted by key in a single grouping, which is combined on the map
    side, so neither a join nor a set of reference keys is needed. Rows without a key
    count as rows; being comparable with nothing, they are not novel.
    """
    arrived = _known(incoming, key, canonical, rule, all_rows=True).select("_ck", F.lit(1).alias("_in"), F.lit(0).alias("_ref"))
    seen = _known(reference, key, canonical, rule, all_rows=True).select("_ck", F.lit(0).alias("_in"), F.lit(1).alias("_ref"))
    per_key = arrived.unionByName(seen).groupBy("_ck").agg(F.sum("_in").alias("_in"), F.sum("_ref").alias("_ref"))
    facts = per_key.agg(
        F.coalesce(F.sum("_in"), F.lit(0)).alias("incoming_rows"),
        F.coalesce(F.sum(F.when(F.col("_ck").isNotNull() & (F.col("_ref") == 0), F.col("_in"))), F.lit(0)).alias("novel_rows"),
        F.coalesce(F.sum("_ref"), F.lit(0)).alias("reference_rows"),
    )
    return facts.select("incoming_rows", "novel_rows", share_of("novel_rows", "incoming_rows").alias("novel_fraction"), "reference_rows")


def retrain_rule(facts: DataFrame, threshold: float, has_champion) -> DataFrame:
    """Add ``retrain`` and ``reason``: no champion yet, or novel enough."""
    novel = F.col("novel_fraction") >= threshold
    percent = F.format_string("%.4f", "novel_fraction")
    reason = (
        F.when(~has_champion, F.lit("no champion yet"))
        .when(novel, F.concat(F.lit("novel fraction "), percent, F.lit(f" reaches {threshold}")))
        .otherwise(F.concat(F.lit("novel fraction "), percent, F.lit(f" is below {threshold}")))
    )
    return facts.withColumn("retrain", ~has_champion | novel).withColumn("reason", reason)
