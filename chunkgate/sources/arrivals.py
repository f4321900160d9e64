"""Arrival identity: the SHA-256 of a landed file's bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkgate.operators.identity import content_digest

WHOLE_FILE_BYTES = 256 * 1024 * 1024
BLOCK_BYTES = 1024 * 1024


def _block_digester() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The function that hashes large files, built here so that workers need no import."""
    block_bytes = BLOCK_BYTES

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        from pyarrow import fs

        for batch in batches:
            digests = []
            for path in batch["path"]:
                local = path.removeprefix("file:")
                store, name = fs.FileSystem.from_uri("/" + local.lstrip("/") if local != path else path)
                sha = hashlib.sha256()
                with store.open_input_stream(name) as stream:
                    while block := stream.read(block_bytes):
                        sha.update(block)
                digests.append(sha.hexdigest())
            yield batch.assign(digest=digests)

    return digest


def file_digests(files: DataFrame, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Path, length and SHA-256 of ``binaryFile`` rows, batch or streaming.

    Files of up to 256 MB are hashed inside the JVM; a larger one is read block by
    block, so its size does not matter to memory. The filters on the length keep each
    branch from loading the other's files.
    """
    small = files.filter(F.col("length") <= whole_file_bytes)
    hashed = small.select("path", "length", F.sha2("content", 256).alias("digest"))
    large = files.select("path", "length").filter(F.col("length") > whole_file_bytes)
    blocks = large.mapInPandas(_block_digester(), "path string, length bigint, digest string")
    return hashed.unionByName(blocks)


def arrival_digests(spark: SparkSession, directory: str, pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    """One row for each file in ``directory`` (``recursive``: in folders below it too): path, length and SHA-256."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return file_digests(reader.option("recursiveFileLookup", recursive).load(directory))


def arrival_digest(spark: SparkSession, path: str) -> str:
    """The identity of an arrived chunk: a file's digest, or that of a folder's set of files."""
    files = spark.read.format("binaryFile").load(path)
    digests = file_digests(files)
    if files.select("path").limit(2).count() == 1:
        return digests.first()["digest"]
    return content_digest(digests, "digest").first()["content_digest"]


def distinct_arrivals(arrivals: DataFrame) -> DataFrame:
    """The first path of each distinct content."""
    order = Window.partitionBy("digest").orderBy("path")
    return arrivals.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
