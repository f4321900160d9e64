"""Rollback, retrain advice and run narratives on a ledger."""

from __future__ import annotations

import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate import defaults
from chunkgate.functions import text
from chunkgate.operators import ledger as questions
from chunkgate.operators.gate import CHECK_TYPE
from chunkgate.operators.novelty import novelty_facts, retrain_rule
from chunkgate.plans.settings import Settings
from chunkgate.sources.chunks import read_chunk
from chunkgate.sources.keyindex import KeyIndex
from chunkgate.sources.ledger import Ledger
from chunkgate.sources.tables import stored


def rollback(ledger: Ledger, model_name: str, reason: str) -> int:
    """Point the champion alias at the newest eligible earlier version; returns it."""
    champion = ledger.champion(model_name)
    if champion is None:
        raise ValueError(f"{model_name!r} has no champion to roll back")
    state = ledger.state().filter(F.col("model_name") == model_name)
    current = state.filter(F.col("version") == champion["version"])
    target = questions.rollback_target(state, current).first()["target_version"]
    if target is None:
        raise ValueError(f"{model_name!r} has no earlier version to go back to")
    when = datetime.now(UTC)
    # The alias last: a crash before it leaves a demoted version that nothing chooses again.
    ledger.tag(model_name, champion["version"], "rolled_back_at", when)
    ledger.tag(model_name, champion["version"], "rollback_reason", when, reason)
    ledger.point_alias(model_name, target, when)
    return target


def roll_back_models(ledger: Ledger, reason: str, when: datetime | None = None) -> DataFrame:
    """Roll back every model that has an earlier eligible version, in three writes, the aliases last.

    Returns one row for each model with a champion: ``current_version`` and ``target_version`` (null: it stays).
    """
    when = when or datetime.now(UTC)
    state = stored(ledger.state(), "versions")
    current = stored(questions.current_champion(state, ledger.read("alias_events")), "champions")
    targets = stored(questions.rollback_target(state, current), "rollbacks")
    moved = targets.where("target_version is not null")
    stamp = F.lit(when).cast("timestamp")
    for tag, note in (("rolled_back_at", F.lit(None)), ("rollback_reason", F.lit(reason))):
        ledger.append("version_tags", moved.select(
            "model_name", F.col("current_version").alias("version"), F.lit(tag).alias("tag"), stamp.alias("stamp"), note.cast("string").alias("note"), stamp.alias("event_time")
        ))
    ledger.append("alias_events", moved.select(
        "model_name", F.lit(defaults.CHAMPION_ALIAS).alias("alias"), F.col("target_version").alias("version"), stamp.alias("event_time"),
        F.lit(time.time_ns()).alias("seq"),
    ))
    return targets


def chunk_facts(incoming: DataFrame, reference: DataFrame | KeyIndex, settings: Settings, ledger: Ledger) -> DataFrame:
    """One row: how new the chunk is, and which champion it would challenge."""
    if isinstance(reference, KeyIndex):
        facts = reference.novelty_facts(incoming, settings.key)
    else:
        facts = novelty_facts(incoming, reference, settings.key)
    champion = ledger.champion(settings.model_name)
    run = None
    if champion is not None:
        run = ledger.read("runs").filter(F.col("run_id") == champion["run_id"]).first()
    known = {
        "champion_version": (champion and champion["version"], "bigint"),
        "champion_promoted_at": (champion and champion["promoted_at"], "timestamp"),
        "champion_model_kind": (run and run["model_kind"], "string"),
        "champion_mae": (run and run["candidate_mae"], "double"),
    }
    return facts.withColumns({name: F.lit(value).cast(kind) for name, (value, kind) in known.items()})


def retrain_advice(spark, raw_path: str, reference: DataFrame | KeyIndex, settings: Settings, ledger: Ledger) -> DataFrame:
    """The facts about an arriving file with ``retrain`` and ``reason``. Triggers nothing."""
    incoming = read_chunk(spark, raw_path, [], settings.multiline, settings.file_format)
    facts = chunk_facts(incoming, reference, settings, ledger)
    return retrain_rule(facts, settings.retrain_threshold, F.col("champion_version").isNotNull())


def narratives(runs: DataFrame) -> DataFrame:
    """A text for each run: the decision and its checks, or the failure."""
    decision = F.from_json("decision", f"checks {CHECK_TYPE}, reason string")
    return runs.withColumn(
        "narrative",
        F.when(
            F.col("status") == questions.FAILED,
            text.failure_text(F.col("failure.error_type"), F.col("failure.error")),
        ).otherwise(
            text.decision_text(F.col("candidate_mae"), F.col("promote"), decision["reason"], decision["checks"])
        ),
    )


def explain_run(ledger: Ledger, run_id: str | None = None) -> str:
    """Write the narrative of a run (by default the last one) and keep it as a note."""
    runs = ledger.read("runs")
    chosen = runs.filter(F.col("run_id") == run_id) if run_id else runs.orderBy(F.desc("start_time"), F.desc("run_id")).limit(1)
    row = narratives(chosen).select("run_id", "narrative").first()
    if row is None:
        raise ValueError("no such run" if run_id else "the ledger is empty")
    ledger.append_row(
        "annotations", run_id=row["run_id"], name="rationale", text=row["narrative"], event_time=datetime.now(UTC)
    )
    return row["narrative"]
