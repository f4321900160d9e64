"""Histogram boosting against a plain single-process version of itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkgate.catalog import judging
from chunkgate.operators import boosting, models

SF = "/root/testdata/sf0.001"


def frame(spark, x, y, parts=4):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(*[None if np.isnan(v) else float(v) for v in r], float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", y double").repartition(parts)
    return models.column_features(df, names, keep_missing=True)


def brute_tree(x, grad, hess, plan):
    """(path, feature, cut, n, value): every cut of every leaf tried, the best leaf split first."""
    grid = [np.unique(c[~np.isnan(c)]) for c in x.T]
    score = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + plan.l2_regularization)
    leaves, nodes = {"": np.ones(len(x), bool)}, {}

    def best(m, path):
        found = None
        if plan.max_depth is not None and len(path) >= plan.max_depth:
            return None
        for f, values in enumerate(grid):
            gone = np.isnan(x[:, f])
            cuts = [*((values[:-1] + values[1:]) / 2), np.inf]
            for to_left in (False, True) if (gone & m).any() else (False,):
                for cut in cuts:
                    a = m & np.where(gone, to_left, x[:, f] <= cut)
                    b = m & ~a
                    if min(a.sum(), b.sum()) >= plan.min_samples_leaf:
                        gain = score(a) + score(b) - score(m)
                        if gain > 1e-9 and (found is None or gain > found[0] * (1 + 1e-12)):
                            found = (gain, f, cut, a, b)
        return found

    cuts = {"": best(leaves[""], "")}
    while len(leaves) < (plan.max_leaf_nodes or 1 << 30) and any(cuts[p] for p in leaves):
        path = max((p for p in leaves if cuts[p]), key=lambda p: cuts[p][0])
        _, f, cut, a, b = cuts[path]
        nodes[path] = (f, cut, int(leaves.pop(path).sum()), None)
        for side, m in (("L", a), ("R", b)):
            leaves[path + side] = m
            cuts[path + side] = best(m, path + side)
    for path, m in leaves.items():
        nodes[path] = (None, None, int(m.sum()), -grad[m].sum() / (hess[m].sum() + plan.l2_regularization) * plan.learning_rate)
    return nodes, leaves


def brute_fit(x, y, plan):
    raw, trees = np.full(len(y), boosting.LOSSES[plan.loss].start(y.mean())), []
    for _ in range(plan.max_iter):
        nodes, leaves = brute_tree(x, *boosting.LOSSES[plan.loss].slopes(y, raw), plan)
        for path, m in leaves.items():
            raw[m] += nodes[path][3]
        trees.append(nodes)
    return trees, boosting.LOSSES[plan.loss].link(raw)


def data(n=300, missing=True):
    rng = np.random.default_rng(11)
    x = np.stack([rng.integers(0, 12, n), rng.integers(0, 5, n) / 4, rng.normal(size=n).round(1)], axis=1)
    y = np.where(x[:, 0] > 6, 4.0, 1.0) * (1 + x[:, 1]) + np.abs(x[:, 2]) + rng.random(n)
    if missing:
        x[rng.random(n) < 0.15, 0] = np.nan
        y[np.isnan(x[:, 0])] += 7
    return x, y


@pytest.mark.parametrize("params", [
    {"max_iter": 3}, {"max_iter": 2, "max_leaf_nodes": 6, "l2_regularization": 3.0}, {"max_iter": 2, "max_depth": 2, "max_leaf_nodes": None},
    {"max_iter": 3, "loss": "poisson", "max_leaf_nodes": 5}, {"max_iter": 1, "min_samples_leaf": 160},
])
def test_trees_equal_brute_force(spark, params):
    x, y = data()
    plan = boosting.Plan(**params)
    fitted = models.fit(frame(spark, x, y), "y", "hist_gbr", params)
    want, predicted = brute_fit(x, y, plan)
    got = boosting.tree_table(fitted.stages[0], spark).collect()
    for k, nodes in enumerate(want):
        mine = {r["path"]: r for r in got if r["tree"] == k}
        assert set(mine) == set(nodes)
        for path, (feature, cut, n, value) in nodes.items():
            r = mine[path]
            assert (r["feature"], r["n_rows"]) == (feature, n)
            assert r["cut"] == (pytest.approx(cut) if cut is not None else None) and r["value"] == (pytest.approx(value) if value is not None else None)
    back = models.predict(fitted, frame(spark, x, y, 1).withColumn("i", F.monotonically_increasing_id()), "p")
    pairs = sorted((r["y"], r["p"]) for r in back.select("y", "p").collect())
    assert np.allclose(pairs, sorted(zip(y, predicted)))


def test_many_values_share_bins(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 2))
    y = (x[:, 0] > 0.5) * 3.0 + x[:, 1] ** 2
    fitted = models.fit(frame(spark, x, y), "y", "hist_gbr", {"max_bins": 16, "max_iter": 20, "max_leaf_nodes": 8})
    cuts = {(r["feature"], r["cut"]) for r in boosting.tree_table(fitted.stages[0], spark).where("feature is not null").collect()}
    assert all(sum(f == k for f, _ in cuts) <= 15 for k in (0, 1))
    judged = models.predict(fitted, frame(spark, x, y), "p").agg(F.avg(F.pow(F.col("p") - F.col("y"), 2))).first()[0]
    assert judged < 0.15 * y.var()


def test_partitions_do_not_matter_and_models_survive_saving(spark, folder):
    x, y = data()
    one = models.fit(frame(spark, x, y, 1), "y", "hist_gbr", {"max_iter": 4})
    many = models.fit(frame(spark, x, y, 9), "y", "hist_gbr", {"max_iter": 4})
    a, b = (boosting.tree_table(m.stages[0], spark).drop("gain", "value").collect() for m in (one, many))
    assert a == b
    models.save(one, f"{folder}/trees")
    both = models.predict(models.load(f"{folder}/trees"), models.predict(one, frame(spark, x, y), "p"), "q")
    assert both.where("p != q or p is null").count() == 0


def test_a_hundred_rounds_beat_ridge_on_lines(spark):
    """Held-out lines whose price follows quantity and discount in steps, as no line can."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "l_quantity", "l_discount", "l_tax", "l_extendedprice / 1000 + 40 * abs(l_quantity - 25) * cast(l_discount > 0.05 as int) as y", "l_orderkey % 5 = 0 as is_test"
    )
    featured = models.column_features(lines, ["l_quantity", "l_discount", "l_tax"])
    train, test = featured.where("not is_test"), featured.where("is_test")
    mae = {}
    for kind, params in (("ridge", {}), ("hist_gbr", {"max_leaf_nodes": 3})):
        judged = models.predict(models.fit(train, "y", kind, params), test, "p")
        mae[kind] = judged.agg(F.avg(F.abs(F.col("p") - F.col("y")))).first()[0]
    assert mae["hist_gbr"] < 0.3 * mae["ridge"]


def test_noise_stops_early(spark):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, (2000, 2)).astype(float), rng.normal(size=2000)
    fitted = models.fit(frame(spark, x, y), "y", "hist_gbr", {"early_stopping": True, "n_iter_no_change": 2, "max_leaf_nodes": 4})
    assert len(fitted.stages[0].content["trees"]) < 20


def test_odd_tables(spark):
    equal = models.fit(frame(spark, np.ones((50, 2)), np.full(50, 2.5)), "y", "hist_gbr", {"max_iter": 2})
    assert {r["p"] for r in models.predict(equal, frame(spark, np.ones((3, 2)), np.zeros(3)), "p").collect()} == {2.5}
    one = models.fit(frame(spark, np.full((1, 1), np.nan), np.array([4.0])), "y", "hist_gbr", {"max_iter": 1})
    assert models.predict(one, frame(spark, np.ones((1, 1)), np.zeros(1)), "p").first()["p"] == 4.0
    with pytest.raises(ValueError, match="no training rows"):
        models.fit(frame(spark, np.ones((2, 1)), np.ones(2)).limit(0), "y", "hist_gbr")
    for bad in ({"max_bins": 256}, {"loss": "huber"}, {"max_leaf_nodes": 1}, {"early_stopping": "never"}):
        with pytest.raises(ValueError):
            boosting.Plan(**bad)


def test_query(spark):
    assert judging.q_gbt_fit(spark, SF, max_iter=3).count() == 3


def test_leaves_are_found_node_by_node():
    tree = boosting.Tree()
    for _ in range(5):
        tree.add(0, 0.0)
    tree.feature[:2], tree.cut[:2], tree.missing_left[:2], tree.left[:2], tree.right[:2] = [0, 1], [0.5, 2.0], [True, False], [1, 3], [2, 4]
    x = np.array([[0.5, 0.6, np.nan, np.nan, 0.1], [2.0, 0.0, 3.0, np.nan, 2.5]])
    assert boosting.nodes_of(tree.arrays(False), x, np.isnan(x)).tolist() == [3, 2, 4, 4, 4]
    assert boosting.nodes_of(tree.arrays(False), x[:, :0], np.isnan(x[:, :0])).tolist() == []


def test_few_trees_are_worked_out_anew_in_a_pass():
    assert boosting.STORE_ROUNDS <= 5
