"""Parquet tables: reading, and storing results that several jobs read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from chunkgate.session import scratch_dir


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table as it lies; ``spark.sql.files.maxPartitionBytes`` sets the size of its pieces."""
    return spark.read.parquet(path)


def stored(df: DataFrame, label: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> DataFrame:
    """Write a result to the shared scratch folder once and read it from there.

    For results that several jobs use: each job then reads the columns and partitions
    it needs, the lineage ends here, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.options(**(options or {})).partitionBy(*partition_by).parquet(path)
    schema = df.schema
    return spark.read.schema(schema).parquet(path).select(df.columns)
