"""Questions about runs, model versions and aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkgate import defaults
from chunkgate.operators.skew import key_set

FINISHED = "FINISHED"
FAILED = "FAILED"
VERSION_BLOCK = 4096


def finished_digests(runs: DataFrame, digest: str = "raw_data_hash") -> DataFrame:
    return key_set(runs.filter(F.col("status") == FINISHED), digest)


def already_trained(arrivals: DataFrame, runs: DataFrame, digest: str = "raw_data_hash") -> DataFrame:
    """Arrivals whose digest is on a finished run. A failed run is only an attempt."""
    return arrivals.join(finished_digests(runs, digest), digest, "left_semi")


def pending_arrivals(arrivals: DataFrame, runs: DataFrame, digest: str = "raw_data_hash") -> DataFrame:
    """Arrivals without a finished run."""
    return arrivals.join(finished_digests(runs, digest), digest, "left_anti")


def retryable_arrivals(runs: DataFrame, digest: str = "raw_data_hash") -> DataFrame:
    """Digests that failed and never finished, with their number of attempts."""
    per_digest = runs.groupBy(digest).agg(
        F.count_if(F.col("status") == FAILED).alias("failed_attempts"),
        F.count_if(F.col("status") == FINISHED).alias("_finished"),
    )
    return per_digest.filter("_finished = 0 and failed_attempts > 0").drop("_finished")


def latest_run(runs: DataFrame) -> DataFrame:
    """The last started run of each model, whatever its status."""
    order = F.struct("start_time", "run_id")
    rest = F.struct(*[c for c in runs.columns if c != "model_name"])
    return runs.groupBy("model_name").agg(F.max_by(rest, order).alias("r")).select("model_name", "r.*")


def failed_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == FAILED)


def outcome_counts(runs: DataFrame, promoted: Column) -> DataFrame:
    """Runs by outcome: promoted, rejected or crashed."""
    outcome = (
        F.when(F.col("status") == FAILED, F.lit("crashed"))
        .when(promoted, F.lit("promoted"))
        .otherwise(F.lit("rejected"))
    )
    return runs.groupBy("model_name", outcome.alias("outcome")).agg(F.count("*").alias("n_runs"))


def current_alias(events: DataFrame, alias: str = defaults.CHAMPION_ALIAS) -> DataFrame:
    """The version each model's alias points at: the last event wins."""
    named = events.filter(F.col("alias") == alias)
    last = F.max_by("version", F.struct("event_time", "seq"))
    return named.groupBy("model_name").agg(last.alias("version"))


def current_champion(versions: DataFrame, events: DataFrame, alias: str = defaults.CHAMPION_ALIAS) -> DataFrame:
    """The version rows that hold the alias, one for each model that has one."""
    return current_alias(events, alias).join(versions, ["model_name", "version"])


def version_state(versions: DataFrame, tags: DataFrame) -> DataFrame:
    """Versions with the last value of each stamp."""

    def last(tag: str, field: str, name: str) -> Column:
        return F.max_by(F.when(F.col("tag") == tag, F.col(field)), F.when(F.col("tag") == tag, F.col("event_time"))).alias(name)

    folded = tags.groupBy("model_name", "version").agg(
        last("promoted_at", "stamp", "promoted_at"),
        last("rolled_back_at", "stamp", "rolled_back_at"),
        last("rollback_reason", "note", "rollback_reason"),
    )
    return versions.join(folded, ["model_name", "version"], "left")


def eligible() -> Column:
    """Promoted once, and not rolled back at or after that promotion."""
    rolled = F.col("rolled_back_at")
    return F.col("promoted_at").isNotNull() & (rolled.isNull() | (rolled < F.col("promoted_at")))


def eligible_versions(state: DataFrame, current: DataFrame) -> DataFrame:
    """Eligible versions older than each model's current one.

    ``current`` has one row for each model; see ``skew`` on why to pass it stored.
    """
    champion = current.select("model_name", F.col("version").alias("_current"))
    older = state.join(champion, "model_name").filter(F.col("version").cast("bigint") < F.col("_current"))
    return older.filter(eligible()).drop("_current")


def rollback_target(state: DataFrame, current: DataFrame) -> DataFrame:
    """The newest eligible version below the current one; null when there is none.

    Versions compare as numbers.
    """
    newest = eligible_versions(state, current).groupBy("model_name").agg(
        F.max(F.col("version").cast("bigint")).alias("target_version")
    )
    return current.select("model_name", F.col("version").alias("current_version")).join(newest, "model_name", "left")


def rollback_state(targets: DataFrame, as_of: Column, reason: str) -> DataFrame:
    """What a rollback writes: the alias moves, the demoted version gets time and reason.

    Models without a target stay as they are. The target keeps its old promotion time.
    """
    moves = F.col("target_version").isNotNull()
    return targets.select(
        "model_name",
        F.coalesce("target_version", "current_version").alias("champion_version"),
        F.when(moves, F.col("current_version")).alias("demoted_version"),
        F.when(moves, as_of).alias("rolled_back_at"),
        F.when(moves, F.lit(reason)).alias("rollback_reason"),
    )


def previous_champion(state: DataFrame) -> DataFrame:
    """For every version, the newest eligible version before it.

    A model's history is cut into blocks of VERSION_BLOCK versions. A running maximum
    over the blocks and one inside each block give the answer together, so a model
    that holds a third of all versions is spread over its blocks. A null model name is
    a model like any other.
    """
    number = F.col("version").cast("bigint")
    blocks = state.withColumn("_block", F.floor(number / VERSION_BLOCK)).withColumn(
        "_eligible", F.when(eligible(), number)
    )
    earlier = Window.partitionBy("model_name").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    tops = (
        blocks.groupBy("model_name", "_block")
        .agg(F.max("_eligible").alias("_top"))
        .withColumn("_before", F.max("_top").over(earlier))
        .select(F.col("model_name").alias("_model"), F.col("_block").alias("_place"), "_before")
    )
    inside = (
        Window.partitionBy("model_name", "_block").orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    )
    same = F.col("model_name").eqNullSafe(F.col("_model")) & F.col("_block").eqNullSafe(F.col("_place"))
    joined = blocks.join(tops, same)
    found = F.coalesce(F.max("_eligible").over(inside), F.col("_before"))
    return joined.withColumn("previous_version", found).drop("_block", "_eligible", "_before", "_model", "_place")


def champion_lineage(champions: DataFrame, runs: DataFrame) -> DataFrame:
    """Each champion with the run that made it."""
    source = runs.select("run_id", "status", "candidate_mae", "model_kind")
    return champions.join(source, "run_id")


def retry_paths(runs: DataFrame, digest: str = "raw_data_hash") -> DataFrame:
    """The retryable arrivals with the path of their last failed run, whose bytes could be read then."""
    failed = runs.filter((F.col("status") == FAILED) & F.col("failure.raw_path").isNotNull())
    last = failed.groupBy(digest).agg(F.max_by(F.col("failure.raw_path"), F.struct("start_time", "run_id")).alias("path"))
    return retryable_arrivals(runs, digest).join(last, digest)
