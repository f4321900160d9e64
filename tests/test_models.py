import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkgate.operators import models


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) * [1.0, 10.0, 0.1]
    y = x @ [2.0, -0.5, 7.0] + 3 + rng.normal(size=400)
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    df = models.column_features(spark.createDataFrame(rows, "a double, b double, c double, y double"), ["a", "b", "c"])
    return df, x, y


@pytest.mark.parametrize("alpha", [0.0, 1.0, 50.0])
def test_ridge_equals_the_closed_form(train, alpha):
    df, x, y = train
    fitted = models.fit(df, "y", "ridge", {"alpha": alpha}).stages[0]
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert list(fitted.coefficients) == pytest.approx(list(w), rel=1e-6)
    assert fitted.intercept == pytest.approx(y.mean() - x.mean(0) @ w, rel=1e-6)


def test_line_equals_the_closed_form(train):
    df, x, y = train
    line = models.fit_lines(df, "b", "y", 2.0).first()
    xc, yc = x[:, 1] - x[:, 1].mean(), y - y.mean()
    slope = xc @ yc / (xc @ xc + 2.0)
    assert line["slope"] == pytest.approx(slope) and line["mean_target"] == pytest.approx(y.mean())
    assert line["intercept"] == pytest.approx(y.mean() - slope * x[:, 1].mean())


@pytest.mark.parametrize(
    "params, want", [({}, "mean"), ({"strategy": "median"}, "median"), ({"strategy": "constant", "constant": 5}, 5.0),
                     ({"strategy": "quantile", "quantile": 0.9}, 0.9)]
)
def test_dummy_predicts_one_number(train, params, want):
    df, _, y = train
    expected = {"mean": y.mean(), "median": np.median(y), 0.9: np.quantile(y, 0.9)}.get(want, want)
    got = models.predict(models.fit(df, "y", "dummy", params), df, "p").select("p").distinct().collect()
    assert [r["p"] for r in got] == [pytest.approx(expected)]


def test_trees_beat_the_mean_and_models_survive_saving(train, folder):
    df, _, y = train
    for kind, params in (("hist_gbr", {"max_iter": 5, "max_depth": 3}), ("ridge", {}), ("dummy", {})):
        fitted = models.fit(df, "y", kind, params)
        models.save(fitted, f"{folder}/{kind}")
        pair = models.predict(models.load(f"{folder}/{kind}"), models.predict(fitted, df, "p"), "q")
        row = pair.agg(F.max(F.abs(F.col("p") - F.col("q"))), F.avg(F.abs(F.col("p") - F.col("y")))).first()
        assert row[0] == 0
        assert kind == "dummy" or row[1] < np.abs(y - y.mean()).mean()


def test_unknown_names_raise(train):
    with pytest.raises(ValueError, match="dummy, hist_gbr, ridge"):
        models.fit(train[0], "y", "forest")
    with pytest.raises(ValueError, match="alpha"):
        models.fit(train[0], "y", "ridge", {"alhpa": 1})
    with pytest.raises(ValueError, match="no training rows"):
        models.fit(train[0].limit(0), "y", "dummy")


def test_fingerprint_vectors_hold_the_bits(spark):
    df = spark.createDataFrame([("a b c",), ("d",)], "k string")
    rows = models.fingerprint_features(df, "k", 1, 64).select("k", "features").collect()
    from test_rows import brute_bits

    for r in rows:
        assert [int(i) for i in r["features"].indices] == brute_bits(r["k"].split(" "), 1, 64)
        assert set(r["features"].values) == {1.0} and r["features"].size == 64
