"""All registered queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chunkgate.catalog import judging, profiles, registers, rows, streams

_ALL = {**rows.QUERIES, **judging.QUERIES, **profiles.QUERIES, **registers.QUERIES, **streams.QUERIES}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql is not None}
