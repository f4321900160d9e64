"""Per-arrival work over a landing directory: consider, train, score."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chunkgate import defaults
from chunkgate.operators.ledger import retry_paths
from chunkgate.plans.registry import retrain_advice
from chunkgate.plans.score import score_chunk
from chunkgate.plans.settings import Settings
from chunkgate.plans.train import train_chunk
from chunkgate.sources.arrivals import arrival_digest
from chunkgate.sources.keyindex import KeyIndex
from chunkgate.sources.ledger import Ledger
from chunkgate.sources.tables import stored
from chunkgate.streaming.arrivals import stream_arrivals

logger = logging.getLogger(__name__)

#: Files that one batch takes on; more than these wait for the next one.
FILES_PER_TRIGGER = 1000


def for_each_batch(
    rows: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, interval: int | None = None
) -> StreamingQuery:
    """Run batch code on each micro-batch: what is there now, or every ``interval`` seconds."""
    trigger = {"processingTime": f"{interval} seconds"} if interval else {"availableNow": True}
    return (
        rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def consider(spark: SparkSession, path: str, reference: DataFrame | KeyIndex, settings: Settings, ledger: Ledger) -> str:
    """Ask the retrain rule about one file and train if it says so. Returns the outcome."""
    advice = retrain_advice(spark, path, reference, settings, ledger).first()
    logger.info("%s: retrain=%s - %s", path, advice["retrain"], advice["reason"])
    if not advice["retrain"]:
        return "advised against"
    result = train_chunk(spark, path, settings, ledger)
    return "promoted" if result.decision["promote"] else "rejected"


def new_files(batch: DataFrame, batch_id: int, seen: str) -> list:
    """The files of a batch whose bytes no earlier batch had, by path; of equal ones the first path.

    ``seen`` is the stream's folder of digests, one part for each batch, so that a batch that is run again after
    a failure decides as it did before. A batch has at most ``files_per_trigger`` files.
    """
    spark = batch.sparkSession
    files = batch.groupBy("digest").agg(F.min("path").alias("path"))
    try:
        before = spark.read.schema("digest string, batch bigint").parquet(seen).where(F.col("batch") < batch_id)
        files = files.join(before.select("digest"), "digest", "left_anti")
    except AnalysisException as error:  # the first batch
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    rows = files.orderBy("path").collect()
    if rows:
        digests = spark.createDataFrame([(r["digest"],) for r in rows], "digest string").coalesce(1)
        digests.write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
    return rows


def _consider_or_park(spark, path, reference, settings, ledger, outcomes) -> None:
    try:
        outcome = consider(spark, path, reference, settings, ledger)
    except Exception as error:
        logger.warning("%s: %s - parked", path, error)
        outcome = "parked"
    if outcomes is not None:
        outcomes(path, outcome)


def retry_failed(
    spark: SparkSession, reference: DataFrame | KeyIndex, settings: Settings, ledger: Ledger, outcomes: Callable[[str, str], None] | None = None
) -> int:
    """Consider once more each file that failed and never finished, by path; returns how many.

    A stream takes a file once, so what failed in a session is taken up again by the next one here. Files that are
    no longer what failed (or are gone) are left to the stream, which meets changed bytes under a new digest.
    """
    runs = ledger.read("runs").where(F.col("model_name") == settings.model_name)
    wanted = stored(retry_paths(runs), "retries").orderBy("path")
    tried = 0
    for row in wanted.toLocalIterator():
        try:
            same = arrival_digest(spark, row["path"]) == row["raw_data_hash"]
        except Exception as error:
            logger.warning("%s: %s - not tried again", row["path"], error)
            continue
        if same:
            tried += 1
            _consider_or_park(spark, row["path"], reference, settings, ledger, outcomes)
    return tried


def watch_training(
    spark: SparkSession,
    directory: str,
    reference: DataFrame | KeyIndex,
    settings: Settings,
    ledger: Ledger,
    checkpoint: str,
    interval: int | None = defaults.POLL_SECONDS,
    outcomes: Callable[[str, str], None] | None = None,
    retry: bool = True,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Train on new files as they land, those of one look at the folder in the order of their paths.

    Files that a finished run was trained on are skipped. A file that fails is parked: its FAILED run is on record,
    the error is logged and the stream goes on. The next session tries it again before it looks for new files.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        for row in new_files(batch, batch_id, f"{checkpoint}/seen-files"):
            if not ledger.has_finished(row["digest"]):
                _consider_or_park(spark, row["path"], reference, settings, ledger, outcomes)

    if retry:
        retry_failed(spark, reference, settings, ledger, outcomes)
    arrivals = stream_arrivals(spark, directory, f"*.{settings.file_format}", files_per_trigger)
    return for_each_batch(arrivals, work, checkpoint, interval)


def watch_scoring(
    spark: SparkSession,
    directory: str,
    settings: Settings,
    ledger: Ledger,
    out: str,
    checkpoint: str,
    interval: int | None = defaults.POLL_SECONDS,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Write a shortlist for each new file as it lands; duplicates are looked for inside
    a file only. A file that fails is logged, noted in the ledger and skipped."""

    def work(batch: DataFrame, batch_id: int) -> None:
        for row in new_files(batch, batch_id, f"{checkpoint}/seen-files"):
            try:
                score_chunk(spark, row["path"], settings, ledger, f"{out}/{row['digest']}")
            except Exception as error:
                logger.warning("%s: %s - parked", row["path"], error)
                ledger.append_row(
                    "annotations", run_id=row["digest"], name="not scored", text=f"{row['path']}: {type(error).__name__}: {error}", event_time=datetime.now(UTC)
                )

    arrivals = stream_arrivals(spark, directory, f"*.{settings.file_format}", files_per_trigger)
    return for_each_batch(arrivals, work, checkpoint, interval)
