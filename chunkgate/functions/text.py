"""Texts of gate checks and run narratives, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Check names, reasons and run lines as they appear in audit records.
SAMPLE_FLOOR = "sample_floor"
COLD_START = "cold_start"
BOOTSTRAP_CI = "bootstrap_ci"
FLOOR_PASSED = "sufficient held-out samples"
FLOOR_FAILED = "insufficient evidence: %d below floor of %d"
NO_CHAMPION = "no champion - candidate becomes first champion"
HAS_CHAMPION = "champion exists - proceed to comparison"
CI_REASON = "ci_low %.3f %s margin %s"
CLEARS = "clears"
FALLS_SHORT = "does not clear"
PASS, FAIL = "PASS", "FAIL"
CANDIDATE_LINE = "candidate mae: %.3f"
PROMOTE_LINE = "promote=%s  reason: %s"
CHECK_LINE = "  [%s] %s: %s"


def floor_reason(n: Column, min_samples: int) -> Column:
    return F.when(n >= min_samples, F.lit(FLOOR_PASSED)).otherwise(
        F.format_string(FLOOR_FAILED, n, F.lit(min_samples))
    )


def ci_reason(ci_low: Column, margin: float) -> Column:
    verdict = F.when(ci_low > margin, F.lit(CLEARS)).otherwise(F.lit(FALLS_SHORT))
    return F.format_string(CI_REASON, ci_low, verdict, F.lit(str(margin)))


def decision_text(mae: Column, promote: Column, reason: Column, checks: Column) -> Column:
    """The run summary: candidate error, verdict, then one line for each check."""

    def line(check: Column) -> Column:
        mark = F.when(check["passed"], F.lit(PASS)).otherwise(F.lit(FAIL))
        return F.format_string(CHECK_LINE, mark, check["name"], check["reason"])

    return F.concat_ws(
        "\n",
        F.format_string(CANDIDATE_LINE, mae),
        F.format_string(PROMOTE_LINE, F.initcap(promote.cast("string")), reason),
        F.array_join(F.transform(checks, line), "\n"),
    )


def failure_text(error_type: Column, error: Column) -> Column:
    return F.concat(F.lit("run failed with "), error_type, F.lit(": "), error)
