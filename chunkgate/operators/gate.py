"""The promotion gate: one decision row for each group, straight from the errors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate import defaults
from chunkgate.functions import text
from chunkgate.operators.bootstrap import bootstrap_ci
from chunkgate.sources.tables import stored

CHECK_TYPE = "array<struct<name:string,passed:boolean,observed:double,threshold:double,reason:string>>"


def _check(name, passed, observed, threshold, reason):
    return F.struct(
        F.lit(name).alias("name"),
        passed.alias("passed"),
        F.lit(observed).cast("double").alias("observed"),
        F.lit(threshold).cast("double").alias("threshold"),
        reason.alias("reason"),
    )


def check_settings(min_samples: int, margin: float, n_boot: int) -> None:
    if min_samples < 0 or margin < 0 or n_boot < 1:
        raise ValueError("min_samples and margin cannot be negative, nor n_boot below 1")


def gate(
    errors: DataFrame,
    key: str,
    by: Sequence[str] = (),
    min_samples: int = defaults.MIN_SAMPLES,
    margin: float = defaults.MARGIN,
    n_boot: int = defaults.N_BOOT,
    seed: int = defaults.GATE_SEED,
    bootstrap: str = "poisson",
) -> DataFrame:
    """Decide every group of ``by`` at once, or the whole table as one group.

    ``errors`` holds a unique ``key``, ``candidate_error`` and ``champion_error``, the
    last null throughout a group that has no champion. The checks run in order and
    stop at the first that settles the matter: too few held-out rows never promotes,
    even on a cold start; no champion promotes; else the lower end of the confidence
    interval must lie above the margin. Checks that did not run are absent and leave
    the interval null.
    """
    check_settings(min_samples, margin, n_boot)
    groups = list(by) or ["_all"]
    if not by:
        errors = errors.withColumn("_all", F.lit(0))
    stats = errors.groupBy(*groups).agg(
        F.count("*").alias("n_rows"),
        F.avg("candidate_error").alias("candidate_mae"),
        (F.avg("champion_error") - F.avg("candidate_error")).alias("_delta"),
        (F.count("champion_error") == 0).alias("_cold"),
    )
    # Rows of groups that the checks before the interval settle are not drawn. Stored, the table of groups has a size
    # that Spark knows: it broadcasts a small one instead of shuffling the errors by group.
    stats = stored(stats, "gate-groups")
    needed = stats.where((F.col("n_rows") >= min_samples) & ~F.col("_cold")).select(*[F.col(c).alias(f"_of_{c}") for c in groups])
    wanted = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in groups])
    compared = errors.join(needed, wanted, "left_semi").filter(F.col("champion_error").isNotNull()).withColumn(
        "_d", F.col("champion_error") - F.col("candidate_error")
    )
    interval = bootstrap_ci(compared, key, "_d", n_boot, seed, by, bootstrap)
    if not by:
        interval = interval.withColumn("_all", F.lit(0))

    n, cold, low = F.col("n_rows"), F.col("_cold"), F.col("ci_low")
    enough = n >= min_samples
    compare = enough & ~cold
    clears = low > margin
    floor = _check(text.SAMPLE_FLOOR, enough, n, min_samples, text.floor_reason(n, min_samples))
    presence = F.when(cold, F.lit(text.NO_CHAMPION)).otherwise(F.lit(text.HAS_CHAMPION))
    start = _check(text.COLD_START, F.lit(True), None, None, presence)
    ci = _check(text.BOOTSTRAP_CI, clears, low, margin, text.ci_reason(low, margin))
    checks = (
        F.when(~enough, F.array(floor).cast(CHECK_TYPE))
        .when(cold, F.array(floor, start).cast(CHECK_TYPE))
        .otherwise(F.array(floor, start, ci).cast(CHECK_TYPE))
    )
    # Null is a group like any other.
    interval = interval.withColumnsRenamed({c: f"_of_{c}" for c in groups})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in groups])
    decided = stats.join(interval, same, "left").select(
        *by,
        n,
        "candidate_mae",
        (enough & (cold | clears)).alias("promote"),
        checks.alias("checks"),
        F.when(compare, F.col("_delta")).alias("delta_observed"),
        F.when(compare, low).alias("ci_low"),
        F.when(compare, F.col("ci_high")).alias("ci_high"),
    )
    return decided.withColumn("reason", F.element_at("checks", -1)["reason"])


def gate_checks(decisions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row for each check that ran, numbered in order."""
    return decisions.select(*by, F.posexplode("checks").alias("check_no", "c")).select(
        *by, "check_no", "c.name", "c.passed", "c.observed", "c.threshold", "c.reason"
    )
