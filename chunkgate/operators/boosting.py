"""Histogram gradient boosting: trees grown best leaf first from sums of gradients by node, feature and bin.

Each feature is cut into bins once: values of their own where there are few, else quantiles; missing values
are a bin of their own. The rows are stored as slices of bin numbers with target and current prediction.
To look for splits, every task sums the gradients of its slices by node, feature and bin, one grouping adds
the tasks' sums up, and the driver compares cuts on sums alone, whose number depends on features, bins and
nodes and not on rows. All nodes that the best-first order could need next are summed in one pass over the
data, so that a tree takes about as many passes as it is deep, not one for each leaf.

The slices lie in the shared folder, so a lost executor costs no more than its share of a pass; they are
written anew with current predictions every ``STORE_ROUNDS`` trees.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.sources.tables import stored

#: The bin of missing values; it bounds ``max_bins`` and lets a bin number be one byte.
MISSING = 255
#: Trees whose predictions are worked out anew in each pass, at most.
STORE_ROUNDS = 5
#: Sums (node times bins of all features) that one pass returns, at most, unless one node has more.
CELLS = 1 << 19
#: Rows of a slice, and bytes of its bin numbers.
SLICE_ROWS, SLICE_BYTES = 1 << 14, 4 << 20
#: Least sum of second derivatives on each side of a cut, and rows from which stopping early is automatic: fixed values.
LEAST_HESSIAN, MANY_ROWS = 1e-3, 10_000


@dataclass(frozen=True)
class Plan:
    """The parameters of a fit, with the names and defaults that users of histogram boosting know."""

    loss: str = "squared_error"
    learning_rate: float = 0.1
    max_iter: int = 100
    max_leaf_nodes: int | None = 31
    max_depth: int | None = None
    min_samples_leaf: int = 20
    l2_regularization: float = 0.0
    max_bins: int = 255
    early_stopping: bool | str = "auto"
    validation_fraction: float = 0.1
    n_iter_no_change: int = 10
    tol: float = 1e-7
    random_state: int = 7

    def __post_init__(self) -> None:
        if self.loss not in LOSSES:
            raise ValueError(f"there is no loss {self.loss}; there are {', '.join(sorted(LOSSES))}")
        if not 2 <= self.max_bins <= MISSING:
            raise ValueError(f"max_bins lies between 2 and {MISSING}")
        if self.max_iter < 1 or self.learning_rate <= 0 or self.min_samples_leaf < 1 or self.l2_regularization < 0:
            raise ValueError("max_iter and min_samples_leaf start at 1, learning_rate above 0, l2_regularization at 0")
        if (self.max_leaf_nodes is not None and self.max_leaf_nodes < 2) or (self.max_depth is not None and self.max_depth < 1):
            raise ValueError("max_leaf_nodes starts at 2 and max_depth at 1")
        if self.early_stopping not in (True, False, "auto") or not 0 < self.validation_fraction < 1 or self.n_iter_no_change < 1 or self.tol < 0:
            raise ValueError("early_stopping is True, False or 'auto', validation_fraction lies between 0 and 1, n_iter_no_change starts at 1, tol at 0")


@dataclass(frozen=True)
class Loss:
    """Link of the prediction, first and second derivative, and the loss itself, on raw predictions."""

    start: Callable[[float], float]
    link: Callable[[np.ndarray], np.ndarray]
    slopes: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    value: Callable[[np.ndarray, np.ndarray], np.ndarray]


LOSSES = {
    "squared_error": Loss(lambda mean: mean, lambda raw: raw, lambda y, raw: (raw - y, np.ones_like(y)), lambda y, raw: (y - raw) ** 2 / 2),
    "poisson": Loss(
        lambda mean: float(np.log(mean)) if mean > 0 else -30.0, np.exp, lambda y, raw: (np.exp(raw) - y, np.exp(raw)), lambda y, raw: np.exp(raw) - y * raw
    ),
}


@dataclass
class Tree:
    """Nodes in arrays: an inner node has a feature (else -1), a cut and its bin, the side of missing values, two children."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, n: int, value: float) -> int:
        for name, v in (("feature", -1), ("bin", 0), ("cut", 0.0), ("missing_left", False), ("left", -1), ("right", -1), ("value", value), ("n", n), ("gain", 0.0)):
            getattr(self, name).append(v)
        return len(self.n) - 1

    def arrays(self, by_bin: bool) -> tuple[np.ndarray, ...]:
        cut = np.array(self.bin) if by_bin else np.array(self.cut)
        return np.array(self.feature), cut, np.array(self.missing_left), np.array(self.left), np.array(self.right)


def nodes_of(arrays: tuple[np.ndarray, ...], x: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """The leaf of each row. ``x`` holds a row for each feature, as bins or as values, like the arrays' cuts."""
    feature, cut, missing_left, left, right = (a.tolist() for a in arrays)
    some_missing = missing.any(axis=1)
    at = np.zeros(x.shape[1], np.int64)
    # Node by node: each holds the places of its rows, so that a feature's numbers are read in order and no row looks its cut up.
    todo = [(0, np.arange(x.shape[1]))]
    while todo:
        node, rows = todo.pop()
        f = feature[node]
        if f < 0:
            at[rows] = node
            continue
        goes_left = x[f][rows] <= cut[node]
        if some_missing[f]:
            goes_left = np.where(missing[f][rows], missing_left[node], goes_left)
        for child, own in ((left[node], rows[goes_left]), (right[node], rows[~goes_left])):
            if len(own):
                todo.append((child, own))
    return at


# Bins ----------------------------------------------------------------------------------


def _distinct(max_bins: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The values of each feature that a task meets, or one row without a value for a feature with too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray | None] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            seen = seen or [np.zeros(0)] * x.shape[1]
            for f, known in enumerate(seen):
                if known is not None:
                    own = x[:, f]
                    known = np.union1d(known, own[~np.isnan(own)])
                    seen[f] = known if len(known) <= max_bins else None
        for f, known in enumerate(seen):
            values = [None] if known is None else known.tolist()
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(values), pa.int32()), pa.array(values, pa.float64())], ["feature", "value"])

    return run


def bin_cuts(rows: DataFrame, n_features: int, max_bins: int) -> list[np.ndarray]:
    """The cuts between the bins of each feature of ``x``: halfway between values, or quantiles where there are too many."""
    met = stored(rows.select("x").mapInArrow(_distinct(max_bins), "feature int, value double").distinct(), "feature-values")
    counts = met.groupBy("feature").agg(F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("more"))
    few = counts.where((F.col("more") == 0) & (F.col("n") <= max_bins)).select("feature")
    values: dict[int, list[float]] = {}
    for row in met.join(few, "feature").collect():  # at most max_bins for each feature
        values.setdefault(row["feature"], []).append(row["value"])
    cuts: list[np.ndarray] = [np.zeros(0)] * n_features
    for f, known in values.items():
        ordered = np.sort(np.array(known))
        cuts[f] = (ordered[:-1] + ordered[1:]) / 2
    many = [r["feature"] for r in counts.where((F.col("more") > 0) | (F.col("n") > max_bins)).collect()]
    shares = [k / max_bins for k in range(1, max_bins)]
    for at in range(0, len(many), 64):
        part = many[at : at + 64]
        value = {f: F.nullif(F.get("x", F.lit(f)), F.lit(float("nan"))) for f in part}
        row = rows.agg(*[F.percentile_approx(value[f], shares, 20 * max_bins).alias(str(f)) for f in part]).first()
        for f in part:
            cuts[f] = np.unique(np.array(row[str(f)], np.float64))
    return cuts


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers, a row for each feature. A value that equals a cut lies below it."""
    out = np.empty(x.shape[::-1], np.uint8)
    for f, c in enumerate(cuts):
        out[f] = np.where(np.isnan(x[:, f]), MISSING, np.searchsorted(c, x[:, f], "left"))
    return out


# Passes over the data ------------------------------------------------------------------

_SLICES = "bins binary, y binary, raw binary, held binary"


def _slice_batch(bins: np.ndarray, y: np.ndarray, raw: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
    parts = [bins.tobytes(), y.astype("<f8").tobytes(), raw.astype("<f8").tobytes(), held.astype(np.uint8).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["bins", "y", "raw", "held"])


def _to_slices(cuts: list[np.ndarray], start: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    step = max(1, min(SLICE_ROWS, SLICE_BYTES // max(1, len(cuts))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                piece = batch.slice(at, step)
                x = piece.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(piece.num_rows, -1)
                y = piece.column("y").to_numpy(zero_copy_only=False)
                yield _slice_batch(binned(x, cuts), y, np.full(len(y), start), piece.column("held").to_numpy(zero_copy_only=False))

    return run


def _opened(batches: Iterator[pa.RecordBatch], trees: list[Tree], n_features: int):
    """Each slice with its predictions brought up to date."""
    arrays = [(t.arrays(True), np.array(t.value)) for t in trees]
    for batch in batches:
        for row in batch.to_pylist():
            y, raw = (np.frombuffer(row[c], "<f8") for c in ("y", "raw"))
            bins = np.frombuffer(row["bins"], np.uint8).reshape(n_features, len(y))
            held = np.frombuffer(row["held"], np.uint8).astype(bool)
            missing = bins == MISSING
            for tree, value in arrays:
                raw = raw + value[nodes_of(tree, bins, missing)]
            yield bins, missing, y, raw, held


def _updated(trees: list[Tree], n_features: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, _, y, raw, held in _opened(batches, trees, n_features):
            yield _slice_batch(bins, y, raw, held)

    return run


def _sums(loss: str, trees: list[Tree], growing: Tree, nodes: list[int], sizes: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows and sums of both derivatives by node, feature and bin; as node -1 the losses of the rows fitted (bin 0) and held out (bin 1)."""
    first = np.concatenate([[0], np.cumsum(sizes)])
    width, n_features = int(first[-1]), len(sizes)
    number = np.full(len(growing.n), -1)
    number[nodes] = np.arange(len(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, g_sum, h_sum = (np.zeros(len(nodes) * width) for _ in range(3))
        losses, rows = np.zeros(2), np.zeros(2, np.int64)
        for bins, missing, y, raw, held in _opened(batches, trees, n_features):
            value = LOSSES[loss].value(y, raw)
            losses += [value[~held].sum(), value[held].sum()]
            rows += [(~held).sum(), held.sum()]
            node = number[nodes_of(growing.arrays(True), bins, missing)]
            kept = np.flatnonzero((node >= 0) & ~held)
            g, h = LOSSES[loss].slopes(y[kept], raw[kept])
            base = node[kept] * width
            for f in range(n_features):
                own = bins[f, kept].astype(np.int64)
                at = base + first[f] + np.where(own == MISSING, sizes[f] - 1, own)
                low, high = (int(at.min()), int(at.max()) + 1) if len(at) else (0, 0)
                for total, weight in ((count, None), (g_sum, g), (h_sum, h)):
                    total[low:high] += np.bincount(at - low, weight, high - low)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -1], pa.int32()), pa.array([0, 0], pa.int32()), pa.array([0, 1], pa.int32()), pa.array(rows), pa.array(losses), pa.array([0.0, 0.0])], _SUMS
        )
        some = np.flatnonzero(count)
        place = some % width
        feature = np.searchsorted(first, place, "right") - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(nodes, np.int32)[some // width]), pa.array(feature.astype(np.int32)), pa.array((place - first[feature]).astype(np.int32)),
                pa.array(count[some].astype(np.int64)), pa.array(g_sum[some]), pa.array(h_sum[some]),
            ],
            _SUMS,
        )

    return run


_SUMS = ["node", "feature", "bin", "n", "g", "h"]


# Growing -------------------------------------------------------------------------------


@dataclass
class Split:
    gain: float
    feature: int
    bin: int
    missing_left: bool
    left: tuple[int, float, float]
    right: tuple[int, float, float]


def best_split(sums: pd.DataFrame, sizes: np.ndarray, total: tuple[int, float, float], plan: Plan) -> Split | None:
    """The cut of one node with the largest gain; of equals the lowest feature, then the lowest bin, then missing values right."""
    penalty = plan.l2_regularization
    n_all, g_all, h_all = total

    def score(g, h):
        return g * g / (h + penalty)

    best = None
    for feature, own in sums.groupby("feature"):
        size = int(sizes[feature])
        n, g, h = (np.bincount(own["bin"], own[c], size) for c in ("n", "g", "h"))
        empty = n[-1] == 0
        for missing_left in (False,) if empty else (False, True):
            lefts = [np.cumsum(v[:-1]) + (v[-1] if missing_left else 0.0) for v in (n, g, h)]
            nl, gl, hl = lefts
            nr, gr, hr = n_all - nl, g_all - gl, h_all - hl
            fine = (nl >= plan.min_samples_leaf) & (nr >= plan.min_samples_leaf) & (hl >= LEAST_HESSIAN) & (hr >= LEAST_HESSIAN) & (n[:-1] > 0)
            if not fine.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(fine, score(gl, hl) + score(gr, hr) - score(g_all, h_all), -np.inf)
            k = int(gain.argmax())
            if gain[k] > 0 and (best is None or gain[k] > best.gain):
                side = bool(nl[k] >= nr[k]) if empty else missing_left
                best = Split(float(gain[k]), int(feature), k, side, (int(nl[k]), float(gl[k]), float(hl[k])), (int(nr[k]), float(gr[k]), float(hr[k])))
    return best


class Booster:
    """One fit: slices, trees so far, and passes."""

    def __init__(self, rows: DataFrame, n_features: int, plan: Plan) -> None:
        self.plan, self.n_features = plan, n_features
        self.cuts = bin_cuts(rows, n_features, plan.max_bins)
        self.sizes = np.array([len(c) + 2 for c in self.cuts])  # the last is for missing values
        size = rows.where("not held").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean")).first()
        if not size["n"]:
            raise ValueError("no training rows")
        self.start = LOSSES[plan.loss].start(size["mean"])
        self.slices = stored(rows.mapInArrow(_to_slices(self.cuts, self.start), _SLICES), "boosting")
        self.tasks = self.slices.rdd.getNumPartitions()
        self.trees: list[Tree] = []
        self.new: list[Tree] = []
        self.losses: tuple[float, float | None] = (float("nan"), None)

    def sums(self, growing: Tree, nodes: list[int]) -> pd.DataFrame:
        run = _sums(self.plan.loss, self.new, growing, nodes, self.sizes)
        partial = self.slices.mapInArrow(run, "node int, feature int, bin int, n long, g double, h double")
        names = ["node", "feature", "bin"]
        if self.tasks * len(nodes) * int(self.sizes.sum()) <= CELLS:  # so few that the driver can add up what tasks return
            return partial.toPandas().groupby(names, as_index=False).sum()
        return partial.groupBy(*names).agg(F.sum("n").alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()

    def splits(self, growing: Tree, nodes: list[int], totals: dict[int, tuple[int, float, float]]) -> dict[int, Split | None]:
        """The best split of each node, several nodes a pass."""
        found = {}
        step = max(1, CELLS // int(self.sizes.sum()))
        for at in range(0, len(nodes), step):
            part = nodes[at : at + step]
            sums = self.sums(growing, part)
            loss = sums[sums["node"] == -1].set_index("bin")
            self.losses = tuple(float(loss["g"][k] / loss["n"][k]) if loss["n"][k] else None for k in (0, 1))
            by_node = dict(list(sums[sums["node"] >= 0].groupby("node")))
            for node in part:
                own = by_node.get(node)
                if own is None:
                    found[node] = None
                    continue
                if node not in totals:
                    one = own[own["feature"] == own["feature"].iloc[0]]
                    totals[node] = (int(one["n"].sum()), float(one["g"].sum()), float(one["h"].sum()))
                found[node] = best_split(own, self.sizes, totals[node], self.plan)
        return found

    def grow(self) -> Tree | None:
        """The next tree, or None when stopping early is due."""
        plan = self.plan
        tree, totals, split, depth = Tree(), {}, {}, {0: 0}
        tree.add(0, 0.0)
        split.update(self.splits(tree, [0], totals))
        if self.stop():
            return None
        while True:
            chosen, pending = self.best_first(tree, split)
            for node in chosen:
                if tree.left[node] < 0:
                    s = split[node]
                    tree.feature[node], tree.bin[node], tree.missing_left[node], tree.gain[node] = s.feature, s.bin, s.missing_left, s.gain
                    cuts = self.cuts[s.feature]
                    tree.cut[node] = float(cuts[s.bin]) if s.bin < len(cuts) else float("inf")
                    for side, sums in (("left", s.left), ("right", s.right)):
                        child = tree.add(sums[0], 0.0)
                        totals[child], depth[child] = sums, depth[node] + 1
                        getattr(tree, side)[node] = child
                        if depth[child] == plan.max_depth or sums[0] < 2 * plan.min_samples_leaf:
                            split[child] = None
            ask = sorted({c for node in pending for c in (tree.left[node], tree.right[node]) if c not in split})
            if not ask:
                return self.pruned(tree, chosen, totals)
            split.update(self.splits(tree, ask, totals))

    def best_first(self, tree: Tree, split: dict[int, Split | None]) -> tuple[list[int], list[int]]:
        """The nodes to split by falling gain, as far as gains are known, and those of them whose children matter for the order."""
        leaves, chosen, pending = 1, [], []
        heap = [(-split[0].gain, 0)] if split[0] else []
        most = self.plan.max_leaf_nodes or float("inf")
        while heap and leaves < most:
            _, node = heapq.heappop(heap)
            chosen.append(node)
            leaves += 1
            if leaves < most:
                pending.append(node)
                for child in (tree.left[node], tree.right[node]):
                    if child >= 0 and split.get(child):
                        heapq.heappush(heap, (-split[child].gain, child))
        return chosen, pending

    def pruned(self, tree: Tree, chosen: list[int], totals: dict[int, tuple[int, float, float]]) -> Tree:
        """The chosen nodes and their leaves, with the leaves' values."""
        out, keep = Tree(), set(chosen)

        def copy(node: int) -> int:
            n, g, h = totals[node]
            value = -g / (h + self.plan.l2_regularization) * self.plan.learning_rate if h > 0 else 0.0
            at = out.add(n, value)
            if node in keep:
                for name in ("feature", "bin", "cut", "missing_left", "gain"):
                    getattr(out, name)[at] = getattr(tree, name)[node]
                out.left[at] = copy(tree.left[node])
                out.right[at] = copy(tree.right[node])
            return at

        if not totals:
            out.add(0, 0.0)
        else:
            copy(0)
        return out

    def stop(self) -> bool:
        """Whether none of the last losses is better than the one before them."""
        self.history.append(self.losses[0] if self.losses[1] is None else self.losses[1])
        back = self.plan.n_iter_no_change + 1
        if not self.stopping or len(self.history) < back:
            return False
        return not any(loss < self.history[-back] - self.plan.tol for loss in self.history[-back + 1 :])

    def fit(self, stopping: bool) -> list[Tree]:
        self.stopping, self.history = stopping, []
        for _ in range(self.plan.max_iter):
            tree = self.grow()
            if tree is None:
                break
            self.trees.append(tree)
            self.new.append(tree)
            if len(self.new) == STORE_ROUNDS:
                self.slices = stored(self.slices.mapInArrow(_updated(self.new, self.n_features), _SLICES), "boosting")
                self.new = []
        return self.trees


# The model -----------------------------------------------------------------------------


class BoostedTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the prediction of boosted trees to rows with a feature vector. Missing values are NaN."""

    featuresCol = Param(Params._dummy(), "featuresCol", "column of feature vectors", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column to add", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "the trees, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", trees="{}"):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", trees="{}")
        self._set(**self._input_kwargs)

    @property
    def content(self) -> dict:
        return json.loads(self.getOrDefault(self.trees))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        content = self.content
        used = sorted({f for t in content["trees"] for f in t["feature"] if f >= 0})
        place = {f: k for k, f in enumerate(used)}
        trees = []
        for t in content["trees"]:
            tree = Tree(**{**t, "feature": [place.get(f, -1) for f in t["feature"]]})
            trees.append((tree.arrays(False), np.array(tree.value)))
        start, loss = content["start"], content["loss"]

        def predict(x: pd.Series) -> pd.Series:
            raw = np.full(len(x), start)
            if used and len(x):
                values = np.stack(x.to_numpy()).astype(np.float64).T
                missing = np.isnan(values)
                for arrays, value in trees:
                    raw += value[nodes_of(arrays, values, missing)]
            return pd.Series(LOSSES[loss].link(raw))

        whole = vector_to_array(F.col(self.getOrDefault(self.featuresCol)))
        picked = F.transform(F.array(*[F.lit(f) for f in used]), lambda i: F.get(whole, i)) if used else F.array(F.lit(0.0))
        return dataset.withColumn(self.getOrDefault(self.predictionCol), F.pandas_udf(predict, "double")(picked))


def fit_boosted(train: DataFrame, features: str, target: str, prediction: str, plan: Plan) -> BoostedTrees:
    """Fit on all rows with a target; a share of them, chosen by hash, only decides when to stop."""
    x = vector_to_array(F.col(features))
    rows = train.where(F.col(target).isNotNull()).select(x.alias("x"), F.col(target).cast("double").alias("y"))
    rows = rows.where(~F.isnan("y"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
    if not size["n"]:
        raise ValueError("no training rows")
    stopping = size["n"] > MANY_ROWS if plan.early_stopping == "auto" else bool(plan.early_stopping)
    held = F.pmod(F.xxhash64(F.lit(plan.random_state), "x", "y"), F.lit(1 << 30)) < int(plan.validation_fraction * (1 << 30))
    rows = rows.withColumn("held", held if stopping else F.lit(False))
    booster = Booster(rows, size["width"], plan)
    trees = booster.fit(stopping)
    content = {"start": booster.start, "loss": plan.loss, "trees": [vars(t) for t in trees]}
    return BoostedTrees(featuresCol=features, predictionCol=prediction, trees=json.dumps(content))


def tree_table(model: BoostedTrees, spark) -> DataFrame:
    """A row for each node: tree, path from the root (L and R), feature and cut of inner nodes, rows, gain, and value of leaves."""
    rows = []

    def visit(k: int, t: dict, node: int, path: str) -> None:
        inner = t["feature"][node] >= 0
        rows.append((
            k, path, t["feature"][node] if inner else None, t["cut"][node] if inner else None, t["n"][node],
            t["gain"][node] if inner else None, None if inner else t["value"][node],
        ))
        if inner:
            visit(k, t, t["left"][node], path + "L")
            visit(k, t, t["right"][node], path + "R")

    for k, t in enumerate(model.content["trees"]):
        visit(k, t, 0, "")
    return spark.createDataFrame(rows, "tree int, path string, feature int, cut double, n_rows long, gain double, value double")
