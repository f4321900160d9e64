"""Queries on models, errors, the promotion gate and shortlists."""

from __future__ import annotations

from pyspark.sql import functions as F

from chunkgate.catalog.bindings import (
    E_ERRORS, E_SPLIT, R_ERRORS, R_SPLIT, boot_sql, multinomial_sql, e_errors, e_split, r4, r_errors, r_lines, r_split, r_valid, table,
)
from chunkgate.functions import text
from chunkgate.operators import boosting, evaluate, models, score
from chunkgate.operators.bootstrap import bootstrap_ci, bootstrap_deltas
from chunkgate.operators.gate import gate, gate_checks
from chunkgate.operators.multinomial import bootstrap_sums
from chunkgate.operators.profile import quantile_table
from chunkgate.operators.split import held_out_rows, train_rows
from chunkgate.plans.score import score_chunk
from chunkgate.plans.settings import Settings
from chunkgate.plans.train import train_chunk
from chunkgate.session import scratch_dir, small_batches
from chunkgate.sources.chunks import write_shortlist
from chunkgate.sources.ledger import Ledger
from chunkgate.sources.tables import stored

LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
E_MIN_SAMPLES = 100


def q_mean_model(spark, sf):
    """The training mean as the prediction of every held-out row."""
    split = e_split(spark, sf)
    mean = train_rows(split).agg(F.avg("target").alias("m")).scalar()
    return held_out_rows(split).select("ord", "target", r4(mean).alias("prediction"))


def q_ridge_single(spark, sf):
    split = r_split(spark, sf)
    lines = models.fit_lines(train_rows(split), "l_quantity", "target", by=["l_returnflag"])
    return lines.select("l_returnflag", "train_rows", r4("slope").alias("slope"), r4("intercept").alias("intercept"))


def q_ridge_multi(spark, sf):
    """Ridge on three columns, fitted by the library, as one row of coefficients."""
    split = r_split(spark, sf).select("target", "is_test", *LINE_FEATURES)
    train = train_rows(models.column_features(split, LINE_FEATURES)).select("features", "target")
    fitted = models.fit(train, "target", "ridge", {"alpha": 1.0}).stages[0]
    row = [round(float(v), 4) for v in (*fitted.coefficients, fitted.intercept)]
    return spark.createDataFrame([tuple(row)], "b_quantity double, b_discount double, b_tax double, intercept double")


def q_ridge_fingerprint(spark, sf):
    """Ridge on the 2,048 fingerprint bits of the documents: held-out predictions."""
    featured = models.fingerprint_features(e_split(spark, sf).select("ord", "k", "target", "is_test"), "k").drop("k")
    with small_batches(spark):
        featured = stored(featured, "documents-bits", ["is_test"])  # fitting and judging read it
    fitted = models.fit(train_rows(featured).select("features", "target"), "target", "ridge")
    return models.predict(fitted, held_out_rows(featured), "prediction").select("ord", "target", "prediction")


def q_gbt_fit(spark, sf, **params):
    """Boosted trees on three columns with the estimator's own defaults: held-out error for each return flag."""
    split = r_split(spark, sf).select("target", "is_test", "l_returnflag", *LINE_FEATURES)
    featured = models.column_features(split, LINE_FEATURES)
    fitted = models.fit(train_rows(featured), "target", "hist_gbr", params)
    judged = models.predict(fitted, held_out_rows(featured), "prediction")
    return evaluate.mae(judged, "prediction", "target", ["l_returnflag"])


def _one_round(spark, sf, leaves):
    """Split, features and the trees of one round with so many leaves, at the full step."""
    split = r_split(spark, sf).select("target", "is_test", "l_returnflag", *LINE_FEATURES)
    featured = models.column_features(split, LINE_FEATURES)
    params = {"max_iter": 1, "learning_rate": 1.0, "max_leaf_nodes": leaves, "early_stopping": False}
    return featured, models.fit(train_rows(featured), "target", "hist_gbr", params)


def q_boosted_stump(spark, sf):
    """One round of one cut: held-out rows and error on each side of it, for each return flag."""
    featured, fitted = _one_round(spark, sf, 2)
    judged = models.predict(fitted, held_out_rows(featured), "prediction").withColumn("prediction", r4("prediction"))
    found = evaluate.mae(judged, "prediction", "target", ["l_returnflag", "prediction"])
    return found.select("l_returnflag", "prediction", "n_rows", r4("mae").alias("mae"))


def q_boosted_leaves(spark, sf):
    """One round of three leaves, best leaf first: the nodes of the tree."""
    _, fitted = _one_round(spark, sf, 3)
    found = boosting.tree_table(fitted.stages[0], spark)
    return found.select("path", "feature", r4("cut").alias("cut"), "n_rows", F.round(F.col("gain") / F.col("n_rows"), 2).alias("gain_a_row"), r4("value").alias("value"))


def q_predictions(spark, sf):
    return e_errors(spark, sf).select("ord", r4("candidate").alias("candidate"), r4("champion").alias("champion"))


def q_abs_errors(spark, sf):
    return e_errors(spark, sf).select("ord", r4("candidate_error").alias("abs_error"))


def _tables(spark, sf):
    """The two models' errors as separate tables, as two prediction jobs would leave them."""
    errors = e_errors(spark, sf)
    candidate = errors.select("ord", F.col("candidate_error").alias("abs_error"))
    champion = errors.select("ord", F.col("champion_error").alias("abs_error"))
    return candidate, champion


def q_paired_errors(spark, sf):
    candidate, champion = _tables(spark, sf)
    evaluate.require_paired(candidate, champion, "ord")
    pairs = evaluate.paired_errors(candidate, champion, "ord")
    return pairs.select(
        "ord", r4("candidate_error").alias("candidate_error"), r4("champion_error").alias("champion_error")
    )


def q_mae(spark, sf):
    split = r_split(spark, sf)
    lines = r_lines(split)
    judged = held_out_rows(split).join(lines, "l_returnflag")
    found = evaluate.mae(judged, "mean_target", "target", ["l_returnflag"])
    return found.select("l_returnflag", "n_rows", r4("mae").alias("mae"))


def q_mae_delta(spark, sf):
    return evaluate.mae_delta(e_errors(spark, sf)).select(
        "n_rows", r4("candidate_mae").alias("candidate_mae"), r4("champion_mae").alias("champion_mae"),
        r4("delta_observed").alias("delta_observed"),
    )


def q_model_metrics(spark, sf):
    """Both models' held-out error for each return flag, one row for each model."""
    delta = evaluate.mae_delta(r_errors(spark, sf), ["l_returnflag"])
    long = delta.unpivot(["l_returnflag", "n_rows"], ["candidate_mae", "champion_mae"], "model", "mae")
    return long.withColumn("mae", r4("mae"))


def q_sample_floor(spark, sf):
    counts = r_errors(spark, sf).groupBy("l_returnflag").agg(F.count("*").alias("n_rows"))
    return counts.select(
        "l_returnflag", "n_rows", (F.col("n_rows") >= 1000).alias("passed"),
        text.floor_reason(F.col("n_rows"), 1000).alias("reason"),
    )


def _delta(errors):
    return errors.withColumn("d", F.col("champion_error") - F.col("candidate_error"))


def q_bootstrap_ci(spark, sf):
    found = bootstrap_ci(_delta(e_errors(spark, sf)), "k", "d")
    return found.select(r4("ci_low").alias("ci_low"), r4("ci_high").alias("ci_high"))


def q_bootstrap_ci_lines(spark, sf):
    found = bootstrap_ci(_delta(r_errors(spark, sf)), "k", "d")
    return found.select(r4("ci_low").alias("ci_low"), r4("ci_high").alias("ci_high"))


def q_bootstrap_replicates(spark, sf):
    found = bootstrap_deltas(_delta(e_errors(spark, sf)), "k", "d")
    return found.select(F.col("replicate").cast("bigint").alias("replicate"), r4("delta").alias("delta"))


def q_multinomial_draws(spark, sf):
    """Each replicate's number of draws, which is the number of rows, and mean difference."""
    found = bootstrap_sums(_delta(e_errors(spark, sf)), "k", "d")
    return found.select(F.col("replicate").cast("bigint").alias("replicate"), "n_draws", r4("delta").alias("delta"))


def q_multinomial_ci(spark, sf):
    found = bootstrap_ci(_delta(e_errors(spark, sf)), "k", "d", method="multinomial")
    return found.select(r4("ci_low").alias("ci_low"), r4("ci_high").alias("ci_high"))


def q_percentile_summary(spark, sf):
    found = quantile_table(table(spark, sf, "orders"), ["o_totalprice"], [0.025, 0.25, 0.5, 0.75, 0.975])
    # Cents between two prices at these shares end after five decimals.
    return found.select("column_name", "share", F.round("value", 6).alias("value"))


def _decision(decided, *by):
    return decided.select(
        *by, F.col("n_rows"), r4("candidate_mae").alias("candidate_mae"), "promote",
        F.size("checks").cast("bigint").alias("n_checks"),
        r4("delta_observed").alias("delta_observed"), r4("ci_low").alias("ci_low"), r4("ci_high").alias("ci_high"),
        "reason",
    )


def q_gate_decision(spark, sf):
    """Documents against the mean with a floor of 100 held-out rows: the candidate wins."""
    return _decision(gate(e_errors(spark, sf), "k", min_samples=E_MIN_SAMPLES))


def q_gate_abstain(spark, sf):
    """Documents with a floor above their number of held-out rows, champion or not."""
    errors = e_errors(spark, sf)
    floor = 1_000_000_000
    warm = _decision(gate(errors, "k", min_samples=floor)).withColumn("cold", F.lit(False))
    cold = gate(errors.withColumn("champion_error", F.lit(None).cast("double")), "k", min_samples=floor)
    return warm.unionByName(_decision(cold).withColumn("cold", F.lit(True)))


def q_gate_cold_start(spark, sf):
    errors = r_errors(spark, sf).withColumn("champion_error", F.lit(None).cast("double"))
    return _decision(gate(errors, "k"))


def q_gate_by_segment(spark, sf):
    return _decision(gate(r_errors(spark, sf), "k", ["l_returnflag"]), "l_returnflag")


def q_gate_checks(spark, sf):
    checks = gate_checks(gate(r_errors(spark, sf), "k", ["l_returnflag"]), ["l_returnflag"])
    return checks.select(
        "l_returnflag", F.col("check_no").cast("bigint").alias("check_no"), "name", "passed",
        r4("observed").alias("observed"), "threshold", "reason",
    )


def q_decision_narrative(spark, sf):
    decided = gate(r_errors(spark, sf), "k", ["l_returnflag"])
    told = text.decision_text(F.col("candidate_mae"), F.col("promote"), F.col("reason"), F.col("checks"))
    return decided.select("l_returnflag", told.alias("narrative"))


def _model_name():
    return F.concat_ws("-", F.concat(F.lit("m"), "user_id"), F.date_format("ts", "yyyyMMdd"))


def q_champion_or_cold_start(spark, sf):
    """Each model's newest run, with the newest promoted one if it has any."""
    runs = table(spark, sf, "events").withColumn("model_name", _model_name())
    newest = F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id"))
    candidates = runs.groupBy("model_name").agg(newest.alias("c")).select(
        "model_name", F.col("c.event_id").alias("run_id"), F.col("c.value").alias("candidate_mae")
    )
    champions = runs.filter("event_type = 'purchase'").groupBy("model_name").agg(newest.alias("c")).select(
        "model_name", F.col("c.event_id").alias("champion_run"), F.col("c.value").alias("champion_mae")
    )
    return evaluate.with_champion(candidates, champions, ["model_name"])


def _scored(spark, sf):
    """Every valid line with the prediction of its return flag's ridge line."""
    split = r_split(spark, sf).select("k", "target", "l_quantity", "l_tax", "l_returnflag", "is_test")
    lines = r_lines(split)
    joined = split.join(lines, "l_returnflag")
    prediction = F.col("intercept") + F.col("slope") * F.col("l_quantity") - 1000 * F.col("l_tax")
    return joined.select("k", "l_returnflag", "target", r4(prediction).alias("predicted_target"))


def q_scored_frame(spark, sf):
    return _scored(spark, sf)


def q_shortlist(spark, sf):
    return score.shortlist(_scored(spark, sf), "predicted_target", "k")


def q_shortlist_desc(spark, sf):
    """Highest first; predictions of lines without tax are NaN and rank last."""
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias("k"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).otherwise(F.lit(float("nan"))).alias("predicted"),
    )
    return score.shortlist(lines, "predicted", "k", ascending=False)


def q_shortlist_head(spark, sf):
    ranked = score.shortlist(_scored(spark, sf), "predicted_target", "k")
    return score.shortlist_head(ranked, "predicted_target", "k")


def _line_features(rows):
    """Three columns of the lines as the model's input."""
    return models.column_features(rows, LINE_FEATURES)


def q_champion_shortlist(spark, sf):
    """Lines as a chunk through the plans: ridge trained and promoted, loaded again by its alias, and the shortlist written."""
    chunk, out = scratch_dir(spark, "lines-chunk"), scratch_dir(spark, "champion-shortlist")
    r_valid(spark, sf).select("k", "target", "l_returnflag", *LINE_FEATURES).write.parquet(chunk)
    book = Ledger(spark, scratch_dir(spark, "lines-ledger"))
    settings = Settings(key="k", target="target", model_name="lines", kind="ridge", min_samples=100, file_format="parquet", features=_line_features)
    train_chunk(spark, chunk, settings, book)
    score_chunk(spark, chunk, settings, book, out)
    found = spark.read.csv(out, header=True, schema=f"k string, target double, l_returnflag string, {', '.join(f'{c} double' for c in LINE_FEATURES)}, predicted_target double")
    return found.select("k", "l_returnflag", "target", r4("predicted_target").alias("predicted_target"))


def q_shortlist_by_segment(spark, sf):
    found = score.shortlist_by_segment(_scored(spark, sf), ["l_returnflag"], "predicted_target", "k", 50)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


def q_shortlist_file(spark, sf):
    """The shortlist written as CSV and read back."""
    path = scratch_dir(spark, "shortlist-csv")
    write_shortlist(score.shortlist(_scored(spark, sf), "predicted_target", "k"), path)
    return spark.read.csv(path, header=True, schema="k string, l_returnflag string, target double, predicted_target double")


def _decision_sql(errors: str, group: str, by: str, min_samples: int) -> str:
    """CTE ``decided`` over an errors CTE, one row for each group."""
    return f""",
stats AS (
  SELECT {group} AS g, count(*) AS n_rows, avg(candidate_error) AS candidate_mae,
    avg(champion_error) - avg(candidate_error) AS delta_observed FROM {errors} GROUP BY 1),
decided AS (
  SELECT {by} n_rows, candidate_mae, n_rows >= {min_samples} AS enough, ci_low > 0.5 AS clears, delta_observed, ci_low,
    ci_high, CASE WHEN n_rows >= {min_samples} THEN 'sufficient held-out samples'
      ELSE 'insufficient evidence: ' || n_rows || ' below floor of {min_samples}' END AS floor_reason,
    'ci_low ' || printf('%.3f', ci_low) || CASE WHEN ci_low > 0.5 THEN ' clears' ELSE ' does not clear' END ||
      ' margin 0.5' AS ci_reason
  FROM stats JOIN ci USING (g))"""


_DECIDED_E = f"WITH {E_ERRORS}{boot_sql('e_errors')}{_decision_sql('e_errors', '0', '', E_MIN_SAMPLES)}"
_DECIDED_R = (
    f"WITH {R_ERRORS}{boot_sql('r_errors', 'l_returnflag')}"
    f"{_decision_sql('r_errors', 'l_returnflag', 'g AS l_returnflag,', 1000)}"
)
_DECISION_COLUMNS = """n_rows, round(candidate_mae, 4) AS candidate_mae, enough AND clears AS promote,
  CAST(CASE WHEN enough THEN 3 ELSE 1 END AS BIGINT) AS n_checks,
  round(CASE WHEN enough THEN delta_observed END, 4) AS delta_observed,
  round(CASE WHEN enough THEN ci_low END, 4) AS ci_low, round(CASE WHEN enough THEN ci_high END, 4) AS ci_high,
  CASE WHEN enough THEN ci_reason ELSE floor_reason END AS reason"""
_NO_CI = """CAST(NULL AS DOUBLE) AS delta_observed, CAST(NULL AS DOUBLE) AS ci_low,
  CAST(NULL AS DOUBLE) AS ci_high"""
_SCORED = f"""WITH {R_SPLIT},
r_fit AS (
  SELECT l_returnflag, covar_pop(target, l_quantity) * count(*) / (var_pop(l_quantity) * count(*) + 1.0) AS slope,
    avg(l_quantity) AS mean_x, avg(target) AS mean_target FROM r_split WHERE NOT is_test GROUP BY l_returnflag),
scored AS (
  SELECT s.k, s.l_returnflag, target,
    round(mean_target - slope * mean_x + slope * l_quantity - 1000 * l_tax, 4) AS predicted_target
  FROM r_split s JOIN r_fit USING (l_returnflag))"""
_MODEL = "'m' || user_id || '-' || strftime(ts, '%Y%m%d')"
# Centred sums of three features and Cramer's rule for (X'X + I) b = X'y.
_RIDGE_WEIGHTS = f"""WITH {R_SPLIT},
s AS (
  SELECT count(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_tax) AS m3, avg(target) AS my,
    var_pop(l_quantity) * count(*) + 1 AS a, covar_pop(l_quantity, l_discount) * count(*) AS b,
    covar_pop(l_quantity, l_tax) * count(*) AS c, var_pop(l_discount) * count(*) + 1 AS d,
    covar_pop(l_discount, l_tax) * count(*) AS e, var_pop(l_tax) * count(*) + 1 AS f,
    covar_pop(l_quantity, target) * count(*) AS p, covar_pop(l_discount, target) * count(*) AS q,
    covar_pop(l_tax, target) * count(*) AS r
  FROM r_split WHERE NOT is_test),
w AS (
  SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det,
    p * (d * f - e * e) - b * (q * f - e * r) + c * (q * e - d * r) AS d1,
    a * (q * f - e * r) - p * (b * f - c * e) + c * (b * r - c * q) AS d2,
    a * (d * r - q * e) - b * (b * r - q * c) + p * (b * e - c * d) AS d3 FROM s)"""
_RIDGE_MULTI = f"""{_RIDGE_WEIGHTS}
SELECT round(d1 / det, 4) AS b_quantity, round(d2 / det, 4) AS b_discount, round(d3 / det, 4) AS b_tax,
  round(my - (d1 * m1 + d2 * m2 + d3 * m3) / det, 4) AS intercept FROM w"""



def _best_cut(rows: str, name: str) -> str:
    """CTEs ``<name>`` (n, total of gradients) and ``<name>_cut`` (feature, cut, gain, rows and gradients below it) of a CTE of rows."""
    values = " UNION ALL ".join(f"SELECT {i} AS feature, {c} AS v, grad FROM {rows}" for i, c in enumerate(LINE_FEATURES))
    return f""",
{name} AS (SELECT count(*) AS n, sum(grad) AS g FROM {rows}),
{name}_sums AS (
  SELECT feature, v, sum(count(*)) OVER below AS nl, sum(sum(grad)) OVER below AS gl, lead(v) OVER (PARTITION BY feature ORDER BY v) AS above
  FROM ({values}) GROUP BY feature, v WINDOW below AS (PARTITION BY feature ORDER BY v)),
{name}_cut AS (
  SELECT feature, (v + above) / 2 AS cut, nl, gl, gl * gl / nl + (g - gl) * (g - gl) / (n - nl) - g * g / n AS gain
  FROM {name}_sums, {name} WHERE above IS NOT NULL AND nl >= 20 AND n - nl >= 20 ORDER BY gain DESC, feature, v LIMIT 1)"""


_SIDE = "CASE feature " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(LINE_FEATURES)) + " END"
_BOOSTED = f"""WITH {R_SPLIT},
base AS (SELECT avg(target) AS mean FROM r_split WHERE NOT is_test),
r0 AS (SELECT *, mean - target AS grad FROM r_split, base WHERE NOT is_test){_best_cut('r0', 'top')}"""
_BOOSTED_STUMP = f"""{_BOOSTED},
judged AS (
  SELECT l_returnflag, target, round(mean + CASE WHEN {_SIDE} <= cut THEN -gl / nl ELSE -(g - gl) / (n - nl) END, 4) AS prediction
  FROM r_split, base, top, top_cut WHERE is_test)
SELECT l_returnflag, prediction, count(*) AS n_rows, round(avg(abs(prediction - target)), 4) AS mae FROM judged GROUP BY 1, 2"""
_BOOSTED_LEAVES = f"""{_BOOSTED},
left_rows AS (SELECT r0.* FROM r0, top_cut WHERE {_SIDE} <= cut), right_rows AS (SELECT r0.* FROM r0, top_cut WHERE {_SIDE} > cut)
{_best_cut('left_rows', 'lower')}{_best_cut('right_rows', 'upper')},
second AS (
  SELECT * FROM (SELECT 'L' AS path, * FROM lower, lower_cut UNION ALL SELECT 'R', * FROM upper, upper_cut) ORDER BY gain DESC, path LIMIT 1),
nodes AS (
  SELECT '' AS path, feature, cut, n, gain, CAST(NULL AS DOUBLE) AS value FROM top, top_cut
  UNION ALL SELECT path, feature, cut, n, gain, NULL FROM second
  UNION ALL SELECT path || 'L', NULL, NULL, nl, NULL, -gl / nl FROM second
  UNION ALL SELECT path || 'R', NULL, NULL, n - nl, NULL, -(g - gl) / (n - nl) FROM second
  UNION ALL SELECT 'L', NULL, NULL, n, NULL, -g / n FROM lower WHERE (SELECT path FROM second) = 'R'
  UNION ALL SELECT 'R', NULL, NULL, n, NULL, -g / n FROM upper WHERE (SELECT path FROM second) = 'L')
SELECT path, CAST(feature AS INTEGER) AS feature, round(cut, 4) AS cut, CAST(n AS BIGINT) AS n_rows, round(gain / n, 2) AS gain_a_row,
  round(value, 4) AS value FROM nodes"""

QUERIES = {
    "mean_model": (q_mean_model, f"""WITH {E_SPLIT} SELECT ord, target,
        (SELECT round(avg(target), 4) FROM e_split WHERE NOT is_test) AS prediction FROM e_split WHERE is_test"""),
    "ridge_single": (q_ridge_single, f"""WITH {R_ERRORS} SELECT l_returnflag, train_rows, round(slope, 4) AS slope,
        round(mean_target - slope * mean_x, 4) AS intercept FROM r_fit"""),
    "ridge_multi": (q_ridge_multi, _RIDGE_MULTI),
    "ridge_fingerprint": (q_ridge_fingerprint, None),
    "gbt_fit": (q_gbt_fit, None),
    "boosted_stump": (q_boosted_stump, _BOOSTED_STUMP),
    "boosted_leaves": (q_boosted_leaves, _BOOSTED_LEAVES),
    "predictions": (q_predictions, f"""WITH {E_ERRORS} SELECT ord, round(candidate, 4) AS candidate,
        round(champion, 4) AS champion FROM e_errors"""),
    "abs_errors": (q_abs_errors, f"WITH {E_ERRORS} SELECT ord, round(candidate_error, 4) AS abs_error FROM e_errors"),
    "paired_errors": (q_paired_errors, f"""WITH {E_ERRORS} SELECT ord, round(candidate_error, 4) AS candidate_error,
        round(champion_error, 4) AS champion_error FROM e_errors"""),
    "mae": (q_mae, f"""WITH {R_ERRORS} SELECT l_returnflag, count(*) AS n_rows, round(avg(champion_error), 4) AS mae
        FROM r_errors GROUP BY l_returnflag"""),
    "mae_delta": (q_mae_delta, f"""WITH {E_ERRORS} SELECT count(*) AS n_rows,
        round(avg(candidate_error), 4) AS candidate_mae, round(avg(champion_error), 4) AS champion_mae,
        round(avg(champion_error) - avg(candidate_error), 4) AS delta_observed FROM e_errors"""),
    "model_metrics": (q_model_metrics, f"""WITH {R_ERRORS}
        SELECT l_returnflag, count(*) AS n_rows, 'candidate_mae' AS model, round(avg(candidate_error), 4) AS mae
          FROM r_errors GROUP BY 1
        UNION ALL SELECT l_returnflag, count(*), 'champion_mae', round(avg(champion_error), 4) FROM r_errors GROUP BY 1"""),
    "sample_floor": (q_sample_floor, f"""WITH {R_ERRORS} SELECT l_returnflag, count(*) AS n_rows, count(*) >= 1000 AS passed,
        CASE WHEN count(*) >= 1000 THEN 'sufficient held-out samples'
          ELSE 'insufficient evidence: ' || count(*) || ' below floor of 1000' END AS reason
        FROM r_errors GROUP BY l_returnflag"""),
    "bootstrap_ci": (q_bootstrap_ci, f"""WITH {E_ERRORS}{boot_sql('e_errors')}
        SELECT round(ci_low, 4) AS ci_low, round(ci_high, 4) AS ci_high FROM ci"""),
    "bootstrap_ci_lines": (q_bootstrap_ci_lines, f"""WITH {R_ERRORS}{boot_sql('r_errors')}
        SELECT round(ci_low, 4) AS ci_low, round(ci_high, 4) AS ci_high FROM ci"""),
    "bootstrap_replicates": (q_bootstrap_replicates, f"""WITH {E_ERRORS}{boot_sql('e_errors')}
        SELECT b AS replicate, round(delta, 4) AS delta FROM boot"""),
    "multinomial_draws": (q_multinomial_draws, f"""WITH RECURSIVE {E_ERRORS}{multinomial_sql('e_errors')}
        SELECT b AS replicate, n_draws, round(delta, 4) AS delta FROM boot"""),
    "multinomial_ci": (q_multinomial_ci, f"""WITH RECURSIVE {E_ERRORS}{multinomial_sql('e_errors')}
        SELECT round(quantile_cont(delta, 0.025), 4) AS ci_low, round(quantile_cont(delta, 0.975), 4) AS ci_high FROM boot"""),
    "percentile_summary": (q_percentile_summary, """SELECT 'o_totalprice' AS column_name, share,
        round(value, 6) AS value FROM (SELECT unnest([0.025::DOUBLE, 0.25, 0.5, 0.75, 0.975]) AS share,
          unnest(quantile_cont(o_totalprice, [0.025, 0.25, 0.5, 0.75, 0.975])) AS value FROM orders)"""),
    "gate_decision": (q_gate_decision, f"{_DECIDED_E} SELECT {_DECISION_COLUMNS} FROM decided"),
    "gate_abstain": (q_gate_abstain, f"""WITH {E_ERRORS},
        t AS (SELECT count(*) AS n_rows, round(avg(candidate_error), 4) AS candidate_mae FROM e_errors)
        SELECT n_rows, candidate_mae, FALSE AS promote, CAST(1 AS BIGINT) AS n_checks, {_NO_CI},
          'insufficient evidence: ' || n_rows || ' below floor of 1000000000' AS reason, cold
        FROM t, (SELECT unnest([TRUE, FALSE]) AS cold)"""),
    "gate_cold_start": (q_gate_cold_start, f"""WITH {R_ERRORS}, t AS (
          SELECT count(*) AS n_rows, round(avg(candidate_error), 4) AS candidate_mae FROM r_errors)
        SELECT n_rows, candidate_mae, n_rows >= 1000 AS promote,
          CAST(CASE WHEN n_rows >= 1000 THEN 2 ELSE 1 END AS BIGINT) AS n_checks, {_NO_CI},
          CASE WHEN n_rows >= 1000 THEN 'no champion - candidate becomes first champion'
            ELSE 'insufficient evidence: ' || n_rows || ' below floor of 1000' END AS reason FROM t"""),
    "gate_by_segment": (q_gate_by_segment, f"{_DECIDED_R} SELECT l_returnflag, {_DECISION_COLUMNS} FROM decided"),
    "gate_checks": (q_gate_checks, f"""{_DECIDED_R}
        SELECT l_returnflag, CAST(0 AS BIGINT) AS check_no, 'sample_floor' AS name, enough AS passed,
          CAST(n_rows AS DOUBLE) AS observed, 1000.0::DOUBLE AS threshold, floor_reason AS reason FROM decided
        UNION ALL SELECT l_returnflag, 1, 'cold_start', TRUE, NULL, NULL,
          'champion exists - proceed to comparison' FROM decided WHERE enough
        UNION ALL SELECT l_returnflag, 2, 'bootstrap_ci', clears, round(ci_low, 4), 0.5, ci_reason
          FROM decided WHERE enough"""),
    "decision_narrative": (q_decision_narrative, f"""{_DECIDED_R} SELECT l_returnflag,
        'candidate mae: ' || printf('%.3f', candidate_mae) || chr(10) ||
        'promote=' || CASE WHEN enough AND clears THEN 'True' ELSE 'False' END || '  reason: ' ||
        CASE WHEN enough THEN ci_reason ELSE floor_reason END || chr(10) ||
        '  [' || CASE WHEN enough THEN 'PASS' ELSE 'FAIL' END || '] sample_floor: ' || floor_reason ||
        CASE WHEN enough THEN chr(10) || '  [PASS] cold_start: champion exists - proceed to comparison' || chr(10) ||
          '  [' || CASE WHEN clears THEN 'PASS' ELSE 'FAIL' END || '] bootstrap_ci: ' || ci_reason ELSE '' END
        AS narrative FROM decided"""),
    "champion_or_cold_start": (q_champion_or_cold_start, f"""WITH r AS (SELECT *, {_MODEL} AS model_name FROM events),
        c AS (SELECT model_name, event_id AS run_id, value AS candidate_mae FROM r
          QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY ts DESC, event_id DESC) = 1),
        h AS (SELECT model_name, event_id AS champion_run, value AS champion_mae FROM r WHERE event_type = 'purchase'
          QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY ts DESC, event_id DESC) = 1)
        SELECT model_name, run_id, candidate_mae, champion_run, champion_mae, champion_run IS NULL AS cold_start
        FROM c LEFT JOIN h USING (model_name)"""),
    "scored_frame": (q_scored_frame, f"{_SCORED} SELECT * FROM scored"),
    "shortlist": (q_shortlist, f"{_SCORED} SELECT * FROM scored ORDER BY predicted_target, k LIMIT 100"),
    "shortlist_desc": (q_shortlist_desc, """WITH t AS (SELECT l_orderkey || ':' || l_linenumber || ':' || l_partkey ||
          ':' || l_suppkey || ':' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS k,
          CASE WHEN l_tax > 0 THEN l_extendedprice ELSE 'nan'::DOUBLE END AS predicted FROM lineitem)
        SELECT * FROM t ORDER BY isnan(predicted), predicted DESC, k LIMIT 100"""),
    "shortlist_head": (q_shortlist_head, f"""{_SCORED} SELECT k, predicted_target FROM scored
        ORDER BY predicted_target, k LIMIT 10"""),
    "champion_shortlist": (q_champion_shortlist, f"""{_RIDGE_WEIGHTS},
        fit AS (SELECT d1 / det AS b1, d2 / det AS b2, d3 / det AS b3, my - (d1 * m1 + d2 * m2 + d3 * m3) / det AS b0 FROM w)
        SELECT k, l_returnflag, target, round(b0 + b1 * l_quantity + b2 * l_discount + b3 * l_tax, 4) AS predicted_target FROM r_split, fit
        ORDER BY round(b0 + b1 * l_quantity + b2 * l_discount + b3 * l_tax, 6), k LIMIT 100"""),
    "shortlist_by_segment": (q_shortlist_by_segment, f"""{_SCORED} SELECT *, row_number() OVER
        (PARTITION BY l_returnflag ORDER BY predicted_target, k) AS rank FROM scored QUALIFY rank <= 50"""),
    "shortlist_file": (q_shortlist_file, f"{_SCORED} SELECT * FROM scored ORDER BY predicted_target, k LIMIT 100"),
}
