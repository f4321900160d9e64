"""Schema checks, row cleaning, keep-first deduplication and its report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkgate.functions.keys import Rule, canonical_key, compact_key
from chunkgate.operators.skew import spread_join


def check_schema(df: DataFrame, key: str, target: str) -> None:
    """Raise unless both columns exist and the target is numeric (a boolean counts)."""
    absent = [name for name in sorted([key, target]) if name not in df.columns]
    if absent:
        raise ValueError(f"the chunk lacks {absent}; it has {df.columns}")
    kind = df.schema[target].dataType
    if not isinstance(kind, (T.NumericType, T.BooleanType)):
        raise ValueError(f"{target} must hold numbers, not {kind.simpleString()}")


def drop_null_rows(df: DataFrame, key: str, target: str) -> DataFrame:
    """Drop rows whose key or target is null or NaN; infinities stay."""
    return df.dropna(subset=[key, target])


def canonicalise(df: DataFrame, key: str, rule: Rule | None = None) -> DataFrame:
    """Rewrite the key to its canonical form, null where it does not parse."""
    return df.withColumn(key, canonical_key(df, key, rule))


def drop_unparseable(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def parsed_rows(df: DataFrame, key: str, rule: Rule | None = None) -> DataFrame:
    """Both steps above at once, each key canonicalised once.

    A filter on the new key would be pushed below it and repeat the work. Exploding
    an array that holds the key, or nothing, drops the row without a filter.
    """
    names = [F.col(c) if c != key else F.col("_key").alias(key) for c in df.columns]
    found = F.array_compact(F.array(canonical_key(df, key, rule)))
    return df.select("*", F.explode(found).alias("_key")).select(*names)


def keep_first(df: DataFrame, key: str, order_by: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The first row of each key in the given order, per chunk if ``by`` is set.

    The rank-one filter lets Spark cut each task's input to one row for each key
    before the shuffle, so a key that holds a third of all rows reaches its reducer
    as one row from each map task.
    """
    order = Window.partitionBy(*by, key).orderBy(*order_by)
    ranked = df.withColumn("_rank", F.row_number().over(order))
    return ranked.filter("_rank = 1").drop("_rank")


def validated(
    df: DataFrame,
    key: str,
    target: str,
    order_by: Sequence[str],
    rule: Rule | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Null rows out, key canonicalised, unparseable out, first spelling kept."""
    check_schema(df, key, target)
    complete = drop_null_rows(df, key, target)
    return keep_first(parsed_rows(complete, key, rule), key, order_by, by)


class DroppedRows:
    """Counts that are gathered while a validated chunk is written: no pass of their own.

    They are known once an action has run on the frame that ``validated_and_counted`` returns.
    """

    def __init__(self) -> None:
        self.raw, self.parsed, self.valid = Observation(), Observation(), Observation()

    @property
    def counts(self) -> dict[str, int]:
        raw, null = (self.raw.get[c] for c in ("n", "incomplete"))
        parsed, valid = self.parsed.get["n"], self.valid.get["n"]
        return {
            "raw_rows": raw, "null_rows": null, "unparseable_rows": raw - null - parsed, "duplicate_rows": parsed - valid,
            "valid_rows": valid, "dropped_rows": raw - valid,
        }


def validated_and_counted(
    df: DataFrame, key: str, target: str, order_by: Sequence[str], rule: Rule | None = None
) -> tuple[DataFrame, DroppedRows]:
    """``validated``, and how many rows each of its steps drops."""
    check_schema(df, key, target)
    dropped, n = DroppedRows(), F.count(F.lit(1)).alias("n")
    raw = df.observe(dropped.raw, n, F.count_if(_incomplete(df, key, target)).alias("incomplete"))
    parsed = parsed_rows(drop_null_rows(raw, key, target), key, rule).observe(dropped.parsed, n)
    return keep_first(parsed, key, order_by).observe(dropped.valid, n), dropped


def _incomplete(df: DataFrame, key: str, target: str):
    no_target = F.col(target).isNull()
    if isinstance(df.schema[target].dataType, (T.DoubleType, T.FloatType)):
        no_target = no_target | F.isnan(target)
    return F.col(key).isNull() | no_target


def require_rows(valid: DataFrame, raw_rows: int) -> None:
    """A chunk with no valid row left is malformed and raises."""
    if valid.isEmpty():
        raise ValueError(f"none of the chunk's {raw_rows} rows is valid")


def validation_report(df: DataFrame, key: str, target: str, rule: Rule | None = None) -> DataFrame:
    """One row: how many rows came in, why rows were dropped, how many remain."""
    check_schema(df, key, target)
    incomplete = _incomplete(df, key, target)
    marked = df.select(
        incomplete.alias("incomplete"),
        F.when(~incomplete, compact_key(canonical_key(df, key, rule))).alias("k"),
    )
    counted = marked.agg(
        F.count("*").alias("raw_rows"),
        F.count_if("incomplete").alias("null_rows"),
        F.count_if(~F.col("incomplete") & F.col("k").isNull()).alias("unparseable_rows"),
        F.count("k").alias("_parsed"),
        F.count_distinct("k").alias("valid_rows"),
    )
    return counted.select(
        "raw_rows",
        "null_rows",
        "unparseable_rows",
        (F.col("_parsed") - F.col("valid_rows")).alias("duplicate_rows"),
        "valid_rows",
        (F.col("raw_rows") - F.col("valid_rows")).alias("dropped_rows"),
    )


def duplicate_rows(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Every member of a key group with two or more rows; rows without a key have no group.

    Counting collapses a hot key on the map side; joining the rows back to the
    repeated keys spreads it over many tasks.
    """
    keyed = df.filter(F.col(key).isNotNull()).withColumn("_ck", compact_key(F.col(key)))
    repeated = keyed.groupBy("_ck").agg(F.count("*").alias("copies")).filter("copies > 1")
    return spread_join(keyed, repeated, "_ck", row_id, "inner", counts="copies").drop("_ck")
