"""Reading arriving chunks and writing shortlists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts that a chunk may hold in place of a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
BOOLEANS = {"True": 1.0, "TRUE": 1.0, "true": 1.0, "False": 0.0, "FALSE": 0.0, "false": 0.0}


def _present(name: str) -> Column:
    return F.when(~F.col(name).isin(NULL_TOKENS), F.col(name))


def _with_order(raw: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Add ``ord``, a row's place: file, block of the file, row in the block.

    It orders rows as the files do, however they are split into tasks.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(*columns, place.alias("ord"))


def read_text_chunk(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """A CSV file or folder with all columns as text, missing values as null, and ``ord``.

    Set ``multiline`` only for values with line breaks, since such a file cannot be split.
    """
    raw = spark.read.csv(path, header=True, multiLine=multiline, escape='"')
    return _with_order(raw, [_present(f"`{c}`").alias(c) for c in raw.columns])


#: Texts that count as numbers; a cast alone also takes 1f, 2D and 0x1p3.
NUMBER = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))$"


def with_numbers(chunk: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn text columns into doubles; a column with any other text stays text.

    One scan decides for all columns whether each holds numbers or truth values only.
    """
    tests = []
    for c in columns:
        given = F.col(c).isNotNull()
        number = F.trim(c).rlike(NUMBER) & F.trim(c).try_cast("double").isNotNull()
        tests.append(F.count_if(given & ~number).alias(f"{c}|number"))
        tests.append(F.count_if(given & ~F.col(c).isin(list(BOOLEANS))).alias(f"{c}|boolean"))
    bad = chunk.agg(*tests).first().asDict() if tests else {}
    truth = F.create_map(*[F.lit(x) for pair in BOOLEANS.items() for x in pair])
    for c in columns:
        if not bad[f"{c}|number"]:
            chunk = chunk.withColumn(c, F.trim(c).try_cast("double"))
        elif not bad[f"{c}|boolean"]:
            chunk = chunk.withColumn(c, truth[F.col(c)])
    return chunk


def read_chunk(
    spark: SparkSession,
    path: str | Sequence[str],
    numeric: Sequence[str],
    multiline: bool = False,
    file_format: str = "csv",
) -> DataFrame:
    """A chunk, one file or a folder of them, with ``ord`` as its arrival order.

    CSV has texts only: the named columns become doubles where they hold numbers.
    Parquet brings its own types.
    """
    if file_format == "parquet":
        raw = spark.read.parquet(path)
        return _with_order(raw, [F.col(f"`{c}`") for c in raw.columns])
    if file_format != "csv":
        raise ValueError(f"chunks are csv or parquet, not {file_format}")
    chunk = read_text_chunk(spark, path, multiline)
    return with_numbers(chunk, [c for c in numeric if c in chunk.columns])


def write_shortlist(ranked: DataFrame, path: str) -> None:
    """Write a shortlist as one CSV file; it has at most the shortlist's rows."""
    ranked.coalesce(1).write.mode("overwrite").csv(path, header=True)
