"""Train on one chunk, judge the candidate, record the run, maybe promote."""

from __future__ import annotations

import json
import logging
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from chunkgate.operators import models
from chunkgate.operators.evaluate import abs_error
from chunkgate.operators.gate import gate
from chunkgate.operators.identity import content_digest
from chunkgate.operators.ledger import FAILED, FINISHED
from chunkgate.operators.split import held_out_rows, train_rows, with_split
from chunkgate.operators.validate import require_rows, validated_and_counted
from chunkgate.plans.settings import Settings
from chunkgate.sources.arrivals import arrival_digest, arrival_digests
from chunkgate.sources.chunks import read_chunk
from chunkgate.sources.ledger import Ledger
from chunkgate.sources.tables import stored

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class TrainResult:
    run_id: str
    decision: Row
    model: PipelineModel
    version: int | None


def signature(settings: Settings) -> str:
    """What a model reads and returns, for the version's record."""
    return json.dumps({"features": settings.feature_signature(), "target": settings.target, "prediction": "double"}, sort_keys=True)


def model_digest(spark, path: str) -> str:
    """The identity of a saved model: that of the set of its files' digests."""
    files = arrival_digests(spark, path, "*", recursive=True).select("digest").distinct()
    return content_digest(files, "digest").first()["content_digest"]


def load_champion(ledger: Ledger, model_name: str, settings: Settings | None = None) -> PipelineModel | None:
    """The champion model, or None when no alias exists. A champion whose files are
    gone raises: a lost model is not a cold start. So does one whose files are not those
    that were registered, or, with ``settings``, one that reads other features.
    """
    row = ledger.champion(model_name)
    if row is None:
        return None
    if settings is not None and row["signature"] is not None and row["signature"] != signature(settings):
        raise ValueError(f"champion {row['version']} of {model_name!r} was fitted for {row['signature']}, not for {signature(settings)}")
    if row["model_digest"] is not None and row["model_digest"] != model_digest(ledger.spark, row["model_path"]):
        raise ValueError(f"the files of champion {row['version']} of {model_name!r} are not those that were registered")
    return models.load(row["model_path"])


def held_out_errors(
    held_out: DataFrame, settings: Settings, candidate: PipelineModel, champion: PipelineModel | None
) -> DataFrame:
    """Errors of both models on each held-out row. One pass predicts with both, so
    the pairing needs no join."""
    judged = models.predict(candidate, held_out, "_candidate")
    if champion is None:
        judged = judged.withColumn("_champion", F.lit(None).cast("double"))
    else:
        judged = models.predict(champion, judged, "_champion")
    return judged.select(
        settings.key,
        abs_error("_candidate", settings.target).alias("candidate_error"),
        abs_error("_champion", settings.target).alias("champion_error"),
    )


def _audit(settings: Settings, ledger: Ledger, run_id: str, started: datetime, **values) -> None:
    ledger.append_row(
        "runs",
        run_id=run_id,
        model_name=settings.model_name,
        start_time=started,
        model_kind=settings.kind,
        config_hash=settings.config_hash(ledger.spark),
        config=json.dumps(settings.config(), sort_keys=True),
        code_version=settings.code_version,
        **values,
    )


def record_failure(
    ledger: Ledger, settings: Settings, raw_path: str, error: BaseException, run_id: str, started: datetime
) -> None:
    """One FAILED run with the chunk's identity and the error."""
    try:
        digest = arrival_digest(ledger.spark, raw_path)
    except Exception:  # whatever keeps the bytes from being read
        digest = "unreadable"
    failure = Row(error_type=type(error).__name__, error=str(error), raw_path=raw_path)
    _audit(settings, ledger, run_id, started, status=FAILED, raw_data_hash=digest, failure=failure)


def promote(ledger: Ledger, settings: Settings, run_id: str, model: PipelineModel) -> int:
    """Save the model, register it as the next version and make it champion."""
    version = ledger.next_version(settings.model_name)
    path = ledger.path(f"models/{settings.model_name}/{version}-{run_id}")
    models.save(model, path)
    when = datetime.now(UTC)
    ledger.register(settings.model_name, version, run_id, path, signature(settings), model_digest(ledger.spark, path))
    ledger.tag(settings.model_name, version, "promoted_at", when)
    ledger.point_alias(settings.model_name, version, when)
    return version


def _train(spark, raw_path: str, settings: Settings, ledger: Ledger):
    digest = arrival_digest(spark, raw_path)
    raw = read_chunk(spark, raw_path, settings.numeric_columns(), settings.multiline, settings.file_format)
    valid, dropped = validated_and_counted(raw, settings.key, settings.target, ["ord"], settings.rule)
    split = with_split(valid, settings.key, settings.test_fraction, settings.split_seed)
    # Validation, split and features are computed once; fitting makes many passes.
    columns = [settings.key, settings.target, models.FEATURES, "is_test"]
    featured = stored(settings.with_features(split).select(columns), "train", ["is_test"])
    if featured.isEmpty():
        require_rows(featured, raw.count())
    candidate = models.fit(train_rows(featured), settings.target, settings.kind, settings.params)
    champion = load_champion(ledger, settings.model_name, settings)
    errors = stored(held_out_errors(held_out_rows(featured), settings, candidate, champion), "errors")
    decision = gate(
        errors, settings.key, (), settings.min_samples, settings.margin, settings.n_boot, settings.gate_seed, settings.bootstrap
    ).first()
    if decision is None:
        raise ValueError("no held-out rows to judge the candidate on")
    content = content_digest(featured, settings.key).first()["content_digest"]
    return digest, content, candidate, decision, dropped.counts


def train_chunk(spark, raw_path: str, settings: Settings, ledger: Ledger) -> TrainResult:
    """Read, validate, split, fit, judge and record one chunk.

    Whatever goes wrong before the decision leaves a FAILED run and is raised again.
    """
    run_id, started = uuid.uuid4().hex, datetime.now(UTC)
    try:
        digest, content, candidate, decision, counts = _train(spark, raw_path, settings, ledger)
    except Exception as error:
        try:
            record_failure(ledger, settings, raw_path, error, run_id, started)
        except Exception:
            logger.exception("the failed run could not be recorded")
        raise
    _audit(
        settings, ledger, run_id, started,
        status=FINISHED, raw_data_hash=digest, dataset_content_hash=content,
        candidate_mae=decision["candidate_mae"], delta_observed=decision["delta_observed"],
        ci_low=decision["ci_low"], ci_high=decision["ci_high"], promote=decision["promote"],
        decision=json.dumps(decision.asDict(recursive=True), sort_keys=True),
        **{c: counts[c] for c in ("raw_rows", "null_rows", "unparseable_rows", "duplicate_rows")},
    )
    version = promote(ledger, settings, run_id, candidate) if decision["promote"] else None
    return TrainResult(run_id, decision, candidate, version)
