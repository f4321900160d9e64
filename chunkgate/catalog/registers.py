"""Queries on the run ledger and the model registry."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from chunkgate import defaults
from chunkgate.catalog.bindings import L_RUNS, ROLLBACK_TIME, V_STATE, l_runs, v_champions, v_state
from chunkgate.functions import text
from chunkgate.operators import ledger
from chunkgate.plans.registry import roll_back_models
from chunkgate.session import scratch_dir
from chunkgate.sources.ledger import Ledger
from chunkgate.sources.tables import stored


def _arrivals(spark, sf):
    return l_runs(spark, sf).groupBy("raw_data_hash").agg(F.min("raw_path").alias("raw_path"))


def _written(spark, sf):
    """The runs appended to a ledger in two writes, finished and failed ones."""
    book = Ledger(spark, scratch_dir(spark, "ledger"))
    failure = F.struct(
        F.lit("ValueError").alias("error_type"), F.col("props").alias("error"), F.col("raw_path").alias("raw_path")
    )
    none = F.lit(None)
    runs = l_runs(spark, sf).withColumns({
        "dataset_content_hash": none, "config_hash": none, "code_version": none, "delta_observed": none,
        "ci_low": none, "ci_high": none, "decision": none, "config": none,
    })
    book.append("runs", runs.filter("status = 'FINISHED'").withColumn("failure", none))
    failed = runs.filter("status = 'FAILED'").withColumns({"failure": failure, "promote": none, "candidate_mae": none})
    book.append("runs", failed)
    return book


def q_run_ledger(spark, sf):
    return _written(spark, sf).read("runs").select(
        F.col("run_id").cast("bigint").alias("run_id"), "model_name", "status", "raw_data_hash", "candidate_mae"
    )


def q_failed_runs(spark, sf):
    failed = ledger.failed_runs(_written(spark, sf).read("runs"))
    told = text.failure_text(F.col("failure.error_type"), F.col("failure.error"))
    return failed.select(
        F.col("run_id").cast("bigint").alias("run_id"), "raw_data_hash", "failure.raw_path", told.alias("narrative")
    )


def q_already_trained(spark, sf):
    return ledger.already_trained(_arrivals(spark, sf), l_runs(spark, sf))


def q_pending_arrivals(spark, sf):
    return ledger.pending_arrivals(_arrivals(spark, sf), l_runs(spark, sf))


def q_retryable_arrivals(spark, sf):
    return ledger.retryable_arrivals(l_runs(spark, sf))


def q_latest_run(spark, sf):
    return ledger.latest_run(l_runs(spark, sf)).select(
        "model_name", "run_id", "status", "start_time", "candidate_mae"
    )


def q_outcome_counts(spark, sf):
    return ledger.outcome_counts(l_runs(spark, sf), F.col("promote"))


def q_eligible_versions(spark, sf):
    state = stored(v_state(spark, sf), "versions")
    return ledger.eligible_versions(state, stored(v_champions(state), "champions"))


def q_rollback_target(spark, sf):
    state = stored(v_state(spark, sf), "versions")
    return ledger.rollback_target(state, stored(v_champions(state), "champions"))


def q_rollback_state(spark, sf):
    state = stored(v_state(spark, sf), "versions")
    targets = ledger.rollback_target(state, stored(v_champions(state), "champions"))
    return ledger.rollback_state(targets, F.lit(ROLLBACK_TIME).cast("timestamp_ntz"), "held-out errors rose")


def q_rollback_written(spark, sf):
    """Every model rolled back in a ledger, and what the ledger says afterwards: champion, demoted version, reason."""
    book = Ledger(spark, scratch_dir(spark, "rollback"))
    state = stored(v_state(spark, sf), "versions")
    book.append("versions", state.select("model_name", "version", "run_id"))
    for tag in ("promoted_at", "rolled_back_at"):
        stamps = state.filter(F.col(tag).isNotNull())
        book.append("version_tags", stamps.select("model_name", "version", F.lit(tag).alias("tag"), F.col(tag).alias("stamp"), F.col(tag).alias("event_time")))
    champions = v_champions(state).withColumn("event_time", F.lit("2024-01-31 00:00:00").cast("timestamp"))
    book.append("alias_events", champions.select("model_name", F.lit(defaults.CHAMPION_ALIAS).alias("alias"), "version", "event_time", F.lit(0).alias("seq")))
    roll_back_models(book, "held-out errors rose", datetime.fromisoformat(ROLLBACK_TIME).replace(tzinfo=UTC))
    champion = ledger.current_alias(book.read("alias_events")).withColumnRenamed("version", "champion_version")
    demoted = book.state().where("rollback_reason is not null").select("model_name", F.col("version").alias("demoted_version"), "rollback_reason")
    return champion.join(demoted, "model_name", "left")


def q_previous_champion(spark, sf):
    return ledger.previous_champion(v_state(spark, sf)).select("model_name", "version", "previous_version")


def _promoted(spark, sf):
    """A ledger in which every promotion of the registry was written in order."""
    book = Ledger(spark, scratch_dir(spark, "registry"))
    state = stored(v_state(spark, sf), "versions")
    book.append("versions", state.select("model_name", "version", "run_id", F.lit(None).alias("model_path")))
    stamps = state.filter(F.col("promoted_at").isNotNull())
    book.append("version_tags", stamps.select(
        "model_name", "version", F.lit("promoted_at").alias("tag"), F.col("promoted_at").alias("stamp"),
        F.lit(None).alias("note"), F.col("promoted_at").alias("event_time"),
    ))
    book.append("alias_events", stamps.select(
        "model_name", F.lit(defaults.CHAMPION_ALIAS).alias("alias"), "version",
        F.col("promoted_at").alias("event_time"), F.col("version").alias("seq"),
    ))
    return book


def _current(spark, sf):
    book = _promoted(spark, sf)
    return ledger.current_champion(book.state(), book.read("alias_events"))


def q_promote(spark, sf):
    """The tables after all promotions: versions, stamped ones, alias moves of each model."""
    book = _promoted(spark, sf)
    stamped = book.state().groupBy("model_name").agg(
        F.count("*").alias("versions"), F.count("promoted_at").alias("promoted")
    )
    moves = book.read("alias_events").groupBy("model_name").agg(F.count("*").alias("alias_moves"))
    return stamped.join(moves, "model_name")


def q_current_champion(spark, sf):
    return _current(spark, sf).select(
        "model_name", "version", F.col("promoted_at").cast("timestamp_ntz").alias("promoted_at")
    )


def q_champion_lineage(spark, sf):
    champions = _current(spark, sf).select("model_name", "version", F.col("run_id").cast("bigint").alias("run_id"))
    return ledger.champion_lineage(champions, l_runs(spark, sf))


def q_version_state(spark, sf):
    """Stamps of every version folded from its tag events."""
    state = stored(v_state(spark, sf), "versions")
    tags = state.filter("promoted_at IS NOT NULL").select(
        "model_name", "version", F.lit("promoted_at").alias("tag"), F.col("promoted_at").alias("stamp"),
        F.lit(None).cast("string").alias("note"), F.col("promoted_at").alias("event_time"),
    ).unionByName(state.filter("rolled_back_at IS NOT NULL").select(
        "model_name", "version", F.lit("rolled_back_at").alias("tag"), F.col("rolled_back_at").alias("stamp"),
        F.lit(None).cast("string").alias("note"), F.col("rolled_back_at").alias("event_time"),
    ))
    return ledger.version_state(state.select("model_name", "version"), tags).select(
        "model_name", "version", "promoted_at", "rolled_back_at"
    )


_ARRIVALS = f"WITH {L_RUNS}, arrivals AS (SELECT raw_data_hash, min(raw_path) AS raw_path FROM runs GROUP BY 1)"
_DONE = "(SELECT raw_data_hash FROM runs WHERE status = 'FINISHED')"
PENDING_SQL = f"{_ARRIVALS} SELECT * FROM arrivals WHERE raw_data_hash NOT IN {_DONE}"
_CURRENT = f"""WITH {V_STATE}, current AS (
  SELECT * FROM state WHERE promoted_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY promoted_at DESC, version DESC) = 1)"""

QUERIES = {
    "rollback_written": (q_rollback_written, f"""WITH {V_STATE} SELECT model_name, coalesce(target_version, current_version) AS champion_version,
        CASE WHEN target_version IS NOT NULL THEN current_version END AS demoted_version,
        CASE WHEN target_version IS NOT NULL THEN 'held-out errors rose' END AS rollback_reason FROM targets"""),
    "run_ledger": (q_run_ledger, f"""WITH {L_RUNS} SELECT run_id, model_name, status, raw_data_hash,
        CASE WHEN status = 'FINISHED' THEN candidate_mae END AS candidate_mae FROM runs"""),
    "failed_runs": (q_failed_runs, f"""WITH {L_RUNS} SELECT run_id, raw_data_hash, raw_path,
        'run failed with ValueError: ' || props AS narrative FROM runs WHERE status = 'FAILED'"""),
    "already_trained": (q_already_trained, f"{_ARRIVALS} SELECT * FROM arrivals WHERE raw_data_hash IN {_DONE}"),
    "pending_arrivals": (q_pending_arrivals, PENDING_SQL),
    "retryable_arrivals": (q_retryable_arrivals, f"""WITH {L_RUNS} SELECT raw_data_hash,
        count(*) AS failed_attempts FROM runs WHERE raw_data_hash NOT IN {_DONE} GROUP BY 1"""),
    "latest_run": (q_latest_run, f"""WITH {L_RUNS} SELECT model_name, run_id, status, start_time, candidate_mae FROM runs
        QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY start_time DESC, run_id DESC) = 1"""),
    "outcome_counts": (q_outcome_counts, f"""WITH {L_RUNS} SELECT model_name,
        CASE WHEN status = 'FAILED' THEN 'crashed' WHEN promote THEN 'promoted' ELSE 'rejected' END AS outcome,
        count(*) AS n_runs FROM runs GROUP BY ALL"""),
    "eligible_versions": (q_eligible_versions, f"WITH {V_STATE} SELECT * FROM eligible"),
    "rollback_target": (q_rollback_target, f"WITH {V_STATE} SELECT * FROM targets"),
    "rollback_state": (q_rollback_state, f"""WITH {V_STATE} SELECT model_name,
        coalesce(target_version, current_version) AS champion_version,
        CASE WHEN target_version IS NOT NULL THEN current_version END AS demoted_version,
        CASE WHEN target_version IS NOT NULL THEN TIMESTAMP '{ROLLBACK_TIME}' END AS rolled_back_at,
        CASE WHEN target_version IS NOT NULL THEN 'held-out errors rose' END AS rollback_reason FROM targets"""),
    "previous_champion": (q_previous_champion, f"""WITH {V_STATE} SELECT model_name, version,
        max(CASE WHEN promoted_at IS NOT NULL AND (rolled_back_at IS NULL OR rolled_back_at < promoted_at)
          THEN version END) OVER (PARTITION BY model_name ORDER BY version
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_version FROM state"""),
    "promote": (q_promote, f"""WITH {V_STATE} SELECT model_name, count(*) AS versions, count(promoted_at) AS promoted,
        count(promoted_at) AS alias_moves FROM state GROUP BY model_name"""),
    "current_champion": (q_current_champion, f"{_CURRENT} SELECT model_name, version, promoted_at FROM current"),
    "champion_lineage": (q_champion_lineage, f"""{_CURRENT}, {L_RUNS} SELECT run_id, c.model_name, version, r.status,
        r.candidate_mae, r.model_kind FROM current c JOIN runs r USING (run_id)"""),
    "version_state": (q_version_state, f"WITH {V_STATE} SELECT model_name, version, promoted_at, rolled_back_at FROM state"),
}
