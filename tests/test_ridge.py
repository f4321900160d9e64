"""Ridge by conjugate gradients against the closed form."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from chunkgate.operators import models, ridge
from chunkgate.session import BATCH_BYTES, small_batches


def frame(spark, x, y, parts=5, sparse=True):
    rows = [(Vectors.sparse(x.shape[1], {int(i): float(r[i]) for i in np.flatnonzero(r)}) if sparse and k % 3 else Vectors.dense(r.tolist()), float(t)) for k, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["features", "y"]).repartition(parts)


def closed(x, y, alpha, intercept=True):
    mean, my = (x.mean(0), y.mean()) if intercept else (np.zeros(x.shape[1]), 0.0)
    xc = x - mean
    w = xc.T @ np.linalg.solve(xc @ xc.T + alpha * np.eye(len(x)), y - my)  # as wide as may be
    return w, my - mean @ w


def data(n, width, density=0.3):
    rng = np.random.default_rng(width)
    x = (rng.random((n, width)) < density * rng.random(width)) * 1.0
    return x, x[:, :5] @ [3.0, -2.0, 1.0, 5.0, 0.5] + rng.normal(size=n) + 40


@pytest.mark.parametrize("width, alpha, intercept, cells", [
    (40, 1.0, True, 1 << 22), (2048, 1.0, True, 1 << 22), (2048, 10.0, True, 1 << 18), (300, 0.5, False, 300 * 20), (8192, 1.0, True, 1 << 20),
])
def test_equals_the_closed_form(spark, width, alpha, intercept, cells):
    x, y = data(160, width)
    w, b, _ = ridge.solve_ridge(frame(spark, x, y), "features", "y", width, alpha, intercept, sketch_cells=cells)
    want, want_b = closed(x, y, alpha, intercept)
    assert np.abs(w - want).max() <= 1e-8 * np.abs(want).max() and b == pytest.approx(want_b, rel=1e-8)


def test_few_features_take_few_steps(spark):
    x, y = data(500, 12)
    x = x * 10.0 ** np.arange(-3, 9) + 1e4
    w, b, steps = ridge.solve_ridge(frame(spark, x, y, sparse=False), "features", "y", 12, 1e-6)
    xc = x - x.mean(0)
    scale = np.linalg.norm(xc, axis=0)
    want = np.linalg.solve((xc / scale).T @ (xc / scale) + np.diag(1e-6 / scale**2), (xc / scale).T @ (y - y.mean())) / scale
    assert steps <= 4 and np.abs((w - want) * scale).max() < 1e-6 * np.abs(want * scale).max()


def test_sums_over_many_tasks(spark):
    x, y = data(64, 30)
    few, many = (ridge.solve_ridge(frame(spark, x, y, parts), "features", "y", 30) for parts in (1, 30))
    assert few[0] == pytest.approx(many[0], rel=1e-9, abs=1e-12)


def test_model_predicts_saves_and_takes_odd_rows(spark, folder):
    x, y = data(90, 25)
    df = frame(spark, x, y)
    odd = spark.createDataFrame([(Vectors.dense([0.0] * 25), None), (None, 3.0), (Vectors.dense([1.0] * 25), float("nan"))], df.schema)
    fitted = models.fit(df.union(odd), "y", "ridge", {"alpha": 2.0})
    want, b = closed(x, y, 2.0)
    assert fitted.stages[0].coefficients.toArray() == pytest.approx(want, abs=1e-9) and fitted.stages[0].intercept == pytest.approx(b)
    models.save(fitted, f"{folder}/ridge")
    back = models.predict(models.load(f"{folder}/ridge"), models.predict(fitted, df.union(odd), "p"), "q")
    assert back.where("not p <=> q").count() == 0 and back.where("p is null").count() == 1
    rows = back.where(F.col("y").isNotNull() & ~F.isnan("y") & F.col("p").isNotNull()).collect()
    assert all(r["p"] == pytest.approx(r["features"].toArray() @ want + b) for r in rows)


def test_constant_columns_and_targets(spark):
    x = np.ones((20, 3))
    x[:, 1] = 0
    w, b, _ = ridge.solve_ridge(frame(spark, x, np.full(20, 7.0)), "features", "y", 3)
    assert np.abs(w).max() < 1e-12 and b == pytest.approx(7.0)
    w, b, _ = ridge.solve_ridge(frame(spark, x, np.arange(20.0)), "features", "y", 3, alpha=0.0)
    assert np.abs(w).max() < 1e-9 and b == pytest.approx(9.5)
    with pytest.raises(ValueError, match="no training rows"):
        models.fit(frame(spark, x, np.ones(20)).limit(0), "y", "ridge")
    with pytest.raises(ValueError, match="alpha"):
        models.fit(frame(spark, x, np.ones(20)), "y", "ridge", {"alpha": -1})


def test_long_sums_come_in_pieces(spark):
    x, y = data(64, 30)
    rows = ridge.Rows(ridge.to_slices(frame(spark, x, y, 30), "features", "y"))
    n = 1 << 19
    rows.tasks = 16  # as many groups as that many tasks make
    found = rows.total(lambda s: np.arange(n) * len(s.y))
    assert found.tolist() == (np.arange(n) * 64.0).tolist()


def test_fingerprints_are_worked_out_once(spark):
    from chunkgate.catalog import judging

    found = judging.q_ridge_fingerprint(spark, "/root/testdata/sf0.001")
    assert found.inputFiles() and all("documents-bits" in f for f in found.inputFiles())


def test_narrow_vectors_do_not_go_to_python(spark):
    x, y = data(160, 40)
    rows = frame(spark, x, y)
    narrow, wide = ({tuple(c.tobytes() for c in (s.starts, s.columns, s.numbers, s.y)) for s in ridge._opened([pa.RecordBatch.from_pandas(ridge.to_slices(rows.coalesce(1).where("features is not null"), "features", "y", w).toPandas())])} for w in (40, None))
    assert len(narrow) == len(wide) == 1  # a slice each: with all numbers, and with those that are not zero
    model = ridge.LinearPredictor(weights=np.arange(40.0).tolist(), constant=2.5)
    odd = rows.select("features").unionByName(spark.createDataFrame([(Vectors.dense([1.0, 2.0]),), (None,)], rows.select("features").schema))
    judged = model.transform(odd)
    assert "Python" not in judged._jdf.queryExecution().executedPlan().toString()
    for r in judged.collect():
        want = None if r.features is None else sum(float(v) * k for k, v in enumerate(r.features.toArray())) + 2.5
        assert r.prediction == (None if want is None else pytest.approx(want, rel=1e-12))
    with pytest.raises(Exception, match="more than the 2 features"):
        ridge.LinearPredictor(weights=[1.0, 2.0]).transform(rows).collect()


def test_workers_hold_little_at_once(spark):
    """One task's slices are 39 MB: neither Parquet nor a batch holds many."""
    x = F.transform(F.sequence(F.lit(1), F.lit(2048)), lambda i: i + F.col("id") * 0.5)
    train = spark.range(0, 1600, 1, 1).select(array_to_vector(x).alias("features"), F.col("id").cast("double").alias("y"))
    rows = ridge.Rows(ridge.to_slices(train, "features", "y"))
    most = 2 * BATCH_BYTES
    assert rows.slices.agg(F.max(F.length("numbers"))).first()[0] <= most // 8
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in rows.slices.inputFiles()]
    assert all(f.row_group(k).total_byte_size <= 2 * most for f in files for k in range(f.num_row_groups))
    n, numbers, large = rows.total(lambda s: np.array([len(s.y), len(s.numbers), s.numbers.nbytes > most], float))
    assert (n, numbers, large) == (1600, 1600 * 2048, 0)


def test_a_batch_of_slices_is_one(spark):
    x, y = data(70, 30)
    x[7:9] = 0  # rows without entries
    stored = ridge.to_slices(frame(spark, x, y, 3), "features", "y").coalesce(1).toPandas()
    three, one = pa.RecordBatch.from_pandas(stored), next(ridge._opened([pa.RecordBatch.from_pandas(stored)]))
    parts = [next(ridge._opened([three.slice(k, 1)])) for k in range(three.num_rows)]
    v = np.arange(30.0)
    assert len(parts) == 3 and one.times(v).tolist() == np.concatenate([p.times(v) for p in parts]).tolist()
    assert sorted(one.times(v).tolist()) == pytest.approx(sorted((x @ v).tolist()))
    assert not list(ridge._opened([three.slice(0, 0)]))


def test_few_tasks_make_a_long_sum(spark):
    most = ridge.LONG_WAVES * spark.sparkContext.defaultParallelism
    train = spark.range(0, 200, 1, 6 * most).select(array_to_vector(F.array(F.lit(1.0))).alias("features"), F.lit(2.0).alias("y"))
    rows = ridge.Rows(ridge.to_slices(train, "features", "y"))
    rows.slices, rows.tasks = rows.slices.repartition(6 * most), 6 * most

    def work(s):
        by_task = np.zeros(ridge.PIECE)
        by_task[TaskContext.get().partitionId()] = len(s.y)
        return by_task

    short, long = (rows.total(work, length) for length in (1, ridge.PIECE))
    assert short.sum() == long.sum() == 200 and np.count_nonzero(long) <= most < np.count_nonzero(short)


@pytest.mark.parametrize("width", [256, 600])
def test_the_matrix_is_summed_by_panels(spark, width):
    x, y = data(160, width)
    w, b, steps = ridge.solve_ridge(frame(spark, x, y), "features", "y", width, 2.0)
    want, want_b = closed(x, y, 2.0)
    assert steps <= 4 and np.abs(w - want).max() <= 1e-8 * np.abs(want).max() and b == pytest.approx(want_b, rel=1e-8)


def test_wide_vectors_are_judged_without_python(spark):
    x, y = data(60, 90)
    weights = np.linspace(-3.0, 4.0, 90)
    odd = spark.createDataFrame([(None, 0.0), (Vectors.sparse(90, {}), 0.0), (Vectors.sparse(90, {4: -2.5}), 0.0), (Vectors.dense([1.0, 2.0]), 0.0)], frame(spark, x, y).schema)
    rows = frame(spark, x, y).union(odd)
    judged = ridge.LinearPredictor(weights=weights.tolist(), constant=2.5).transform(rows)
    assert "Python" not in judged._jdf.queryExecution().executedPlan().toString() and judged.columns == ["features", "y", "prediction"]
    for r in judged.collect():
        want = None if r.features is None else sum(float(v) * w for v, w in zip(r.features.toArray(), weights)) + 2.5
        assert r.prediction == (None if want is None else pytest.approx(want, rel=1e-12))
    with pytest.raises(Exception, match="more than the 70 features"):
        ridge.LinearPredictor(weights=weights[:70].tolist()).transform(rows).collect()


def test_widest_vectors_are_judged_in_parts(spark, monkeypatch):
    x, y = data(60, 90)
    rows = frame(spark, x, y, 1).union(spark.createDataFrame([(None, 0.0)], frame(spark, x, y).schema))
    model = ridge.LinearPredictor(weights=np.linspace(-3.0, 4.0, 90).tolist(), constant=2.5)
    want = {r.y: r.prediction for r in model.transform(rows).collect()}
    monkeypatch.setattr(ridge, "WRITTEN", 80)
    judged = model.transform(rows)
    assert "ArrowEvalPython" in judged._jdf.queryExecution().executedPlan().toString()
    assert {r.y: r.prediction for r in judged.collect()} == want


def test_a_sessions_own_batches_stay(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    with small_batches(spark):
        assert spark.conf.get(name) == str(BATCH_BYTES)
    assert spark.conf.get(name, None) is None
    spark.conf.set(name, "1000000")
    try:
        with small_batches(spark):
            assert spark.conf.get(name) == "1000000"
        assert spark.conf.get(name) == "1000000"
    finally:
        spark.conf.unset(name)
