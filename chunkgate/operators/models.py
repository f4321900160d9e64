"""Regressors: fitting, applying, saving and loading."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import fields

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkgate import defaults
from chunkgate.functions.fingerprint import fingerprint_bits
from chunkgate.operators.boosting import Plan, fit_boosted
from chunkgate.operators.quantiles import exact_quantiles
from chunkgate.operators.ridge import TOLERANCE, LinearPredictor, solve_ridge

FEATURES = "features"
PREDICTION = "prediction"


def fingerprint_features(
    df: DataFrame, key: str, radius: int = defaults.FP_RADIUS, n_bits: int = defaults.FP_BITS
) -> DataFrame:
    """Add the key's fingerprint as a sparse 0/1 vector ``features``."""
    bits = fingerprint_bits(F.split(F.col(key), " "), radius, n_bits)
    worded = df.withColumn("_bits", bits.cast("array<string>"))
    # A fixed vocabulary puts bit i at index i without a fitting pass.
    to_vector = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(n_bits)], inputCol="_bits", outputCol=FEATURES, binary=True
    )
    return to_vector.transform(worded).drop("_bits")


def column_features(df: DataFrame, columns: Sequence[str], keep_missing: bool = False) -> DataFrame:
    """Add numeric columns as the vector ``features``; missing values raise, or become NaN for trees."""
    invalid = "keep" if keep_missing else "error"
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES, handleInvalid=invalid).transform(df)


def _take(params: dict, **known):
    unknown = sorted(set(params) - set(known))
    if unknown:
        raise ValueError(f"unknown model parameters {unknown}; choose from {sorted(known)}")
    return {**known, **params}


def _fit_dummy(train: DataFrame, target: str, params: dict) -> PipelineModel:
    chosen = _take(params, strategy="mean", constant=None, quantile=None)
    if chosen["strategy"] == "mean":
        value = train.agg(F.avg(target)).first()[0]
    elif chosen["strategy"] == "median":
        value = exact_quantiles(train, target, [0.5])[0]
    elif chosen["strategy"] == "quantile" and chosen["quantile"] is not None:
        value = exact_quantiles(train, target, [chosen["quantile"]])[0]
    elif chosen["strategy"] == "constant" and chosen["constant"] is not None:
        value = float(chosen["constant"])
    else:
        raise ValueError(f"dummy cannot fit {params}")
    if value is None:
        raise ValueError("no training rows")
    constant = f"SELECT *, CAST('{value!r}' AS DOUBLE) AS {PREDICTION} FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=constant)])


def _fit_ridge(train: DataFrame, target: str, params: dict) -> PipelineModel:
    """Least squares with penalty alpha * |w|^2 and a free intercept, at any number of features."""
    chosen = _take(params, alpha=1.0, fit_intercept=True, tol=TOLERANCE, max_iter=2000)
    if chosen["alpha"] < 0:
        raise ValueError("alpha cannot be negative")
    one = train.where(F.col(FEATURES).isNotNull()).select(FEATURES).first()
    if one is None:
        raise ValueError("no training rows")
    weights, intercept, _ = solve_ridge(
        train, FEATURES, target, one[0].size, float(chosen["alpha"]), bool(chosen["fit_intercept"]), chosen["tol"], chosen["max_iter"]
    )
    return PipelineModel([LinearPredictor(featuresCol=FEATURES, predictionCol=PREDICTION, weights=weights.tolist(), constant=float(intercept))])


def _fit_boosted(train: DataFrame, target: str, params: dict) -> PipelineModel:
    plan = Plan(**_take(params, **{f.name: f.default for f in fields(Plan)}))
    return PipelineModel([fit_boosted(train, FEATURES, target, PREDICTION, plan)])


BUILDERS: dict[str, Callable[[DataFrame, str, dict], PipelineModel]] = {
    "dummy": _fit_dummy,
    "hist_gbr": _fit_boosted,
    "ridge": _fit_ridge,
}


def check_kind(kind: str) -> None:
    if kind not in BUILDERS:
        raise ValueError(f"no estimator is called {kind}; there are {', '.join(sorted(BUILDERS))}")


def fit(train: DataFrame, target: str, kind: str = defaults.MODEL_KIND, params: dict | None = None) -> PipelineModel:
    """Fit the named estimator on the ``features`` and target columns."""
    check_kind(kind)
    return BUILDERS[kind](train, target, dict(params or {}))


def predict(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """Add the model's prediction under the given name."""
    return model.transform(df).withColumnRenamed(PREDICTION, name)


def save(model: PipelineModel, path: str) -> None:
    model.write().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_lines(train: DataFrame, x: str, target: str, alpha: float = 1.0, by: Sequence[str] = ()) -> DataFrame:
    """One-feature ridge and the mean model of every group, from one aggregate.

    Returns ``slope`` and ``intercept`` of the ridge line and ``mean_target``.
    """
    n = F.count(target)
    slope = F.covar_pop(x, target) * n / (F.var_pop(x) * n + alpha)
    sums = train.groupBy(*by).agg(
        n.alias("train_rows"), slope.alias("slope"), F.avg(x).alias("_x"), F.avg(target).alias("mean_target")
    )
    intercept = F.col("mean_target") - F.col("slope") * F.col("_x")
    return sums.select(*by, "train_rows", "slope", intercept.alias("intercept"), "mean_target")


def line_columns(lines: DataFrame, fields: Sequence[str] = ("slope", "intercept", "mean_target")) -> Column:
    """A one-row table of lines as a scalar struct, usable on every row without a join."""
    return lines.select(F.struct(*fields)).scalar()
