"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

# AQE sizes the reducers at run time and splits skewed join partitions, so the
# same code runs on eight threads and on a thousand executors.
_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Where wide rows go to Python. Spark's own 64 MB take several times as much for each core, outside the heap.
BATCH_BYTES = 1 << 22
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("chunkgate")
    settings = {
        **_CONF,
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="chunkgate-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session, where one machine is the whole cluster, may fall back
    to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand rows to Python in batches of ``BATCH_BYTES``, or of one row; a session's own setting stays."""
    own = spark.conf.get(_BATCH_CONF, None)
    if own is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_BATCH_CONF)
