"""A landing directory as a stream of arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chunkgate.sources.arrivals import file_digests

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_arrivals(
    spark: SparkSession, directory: str, pattern: str = "*.csv", files_per_trigger: int | None = None,
    recursive: bool = False,
) -> DataFrame:
    """One streaming row for each landed file (``recursive``: in folders too): path, length and SHA-256 of its bytes.

    Land files by rename or under another name first; the source takes a file once.
    """
    reader = (
        spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("pathGlobFilter", pattern)
    )
    reader = reader.option("recursiveFileLookup", recursive)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return file_digests(reader.load(directory))


def stream_distinct_arrivals(arrivals: DataFrame) -> DataFrame:
    """Drop files whose bytes came before. The state holds one digest for each distinct
    file and survives a restart through the checkpoint."""
    return arrivals.dropDuplicates(["digest"])


def append_stream(rows: DataFrame, out: str, checkpoint: str, interval: int | None = None) -> StreamingQuery:
    """Append a stream to a parquet folder: all that is there now, or every ``interval`` seconds."""
    trigger = {"processingTime": f"{interval} seconds"} if interval else {"availableNow": True}
    return (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
