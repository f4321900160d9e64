"""Column expressions on entity keys: canonical form, stable hashes, compact identity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = Callable[[Column], Column]

# The held-out test divides 32 hash bits by the largest 32-bit number.
UNIT_DIVISOR = 4294967295


def collapsed_text(value: Column) -> Column:
    """Default canonical form of a text key: lower case, single spaces, no outer blanks.

    A text of blanks only does not parse.
    """
    # Most keys have no blanks; they need neither the replacement nor the second search.
    one = F.when(~value.rlike(r"\s"), F.nullif(F.lower(value), F.lit("")))
    return one.when(value.rlike(r"\S"), F.lower(F.trim(F.regexp_replace(value, r"\s+", " "))))


def canonical_key(df: DataFrame, key: str, rule: Rule | None = None) -> Column:
    """The canonical key column, null where the value is no string or the rule rejects it.

    ``rule`` maps a column to a column; it may wrap a pandas UDF when the canonical
    form cannot be written with built-in functions.
    """
    if not isinstance(df.schema[key].dataType, T.StringType):
        return F.lit(None).cast("string")
    return (rule or collapsed_text)(F.col(key))


def hash32(text: Column, part: int = 0) -> Column:
    """32 bits of md5(text) as a bigint; ``part`` 0-3 picks the quarter of the digest."""
    return F.conv(F.substring(F.md5(text), 1 + 8 * part, 8), 16, 10).cast("bigint")


def unit_hash(seed: int, key: Column) -> Column:
    """Position of a key in [0, 1], equal on every engine, partitioning and run."""
    return hash32(F.concat(F.lit(f"{seed}:"), key)) / F.lit(float(UNIT_DIVISOR))


def compact_key(key: Column) -> Column:
    """The key itself when short, else its SHA-256 behind a marker.

    Grouping and joining then shuffle at most 65 characters for a long text. The
    marker makes a digest one character longer than any key that is kept.
    """
    return F.when(F.length(key) <= 64, key).otherwise(F.concat(F.lit("#"), F.sha2(key, 256)))
