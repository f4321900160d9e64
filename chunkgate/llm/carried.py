"""Columns that an operator doesn't read, out of the way of its own names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "rest_of_row"


def _others(columns: list[str], read: tuple[str, ...]) -> list[str]:
    return [c for c in columns if c not in read]


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def carry(rows: DataFrame, read: tuple[str, ...]) -> DataFrame:
    """``read`` as they are, all other columns in one struct with field names of its own."""
    others = _others(rows.columns, read)
    own = [c for c in rows.columns if c in read]
    rest = [F.struct(*[_named(c).alias(f"c{k}") for k, c in enumerate(others)]).alias(REST)] if others else []
    return rows.select(*own, *rest)


def unpack(columns: list[str], read: tuple[str, ...]) -> list[Column]:
    """``columns`` of the rows that were carried, in their order and with their names."""
    at = {c: k for k, c in enumerate(_others(columns, read))}
    return [_named(c) if c in read else F.col(REST)[f"c{at[c]}"].alias(c) for c in columns]
