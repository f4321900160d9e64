"""Ridge regression at any width by preconditioned conjugate gradients.

The normal equations (X'X + alpha) w = X'y of the centred columns are never formed. Rows lie as slices of sparse
rows; a step multiplies every slice by a vector and by its transpose inside the tasks, and the tasks' results
are added up in two folds: a short vector by groups of tasks, so that the driver gets one for each of about the square
root of the tasks, a long one by its pieces, so that the driver gets it once. Every task writes its sum, so a long one
is left to few tasks. Rows go to Python in small batches and are taken apart a slice at a time.

The number of steps depends on how far the eigenvalues lie apart. One first pass multiplies X'X by as many
random columns as fit in ``SKETCH_CELLS``; a Nystroem approximation from it takes the leading eigenvalues
out of the way. With few features the matrix itself is summed, and one or two steps remain.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkgate.operators.slices import Slice, _all, _entries, _opened, _parts
from chunkgate.session import BATCH_BYTES, small_batches
from chunkgate.sources.tables import stored

#: Numbers in the sketch, which each task and the driver hold.
SKETCH_CELLS = 1 << 22
#: Rows that are multiplied by the sketch's columns at once; by each other, as many as have so many numbers.
SKETCH_ROWS, BLOCK_CELLS = 256, 1 << 19
#: The residual to reach, in units of the right side; steps without a smaller one after which the search ends.
TOLERANCE, PATIENCE = 1e-13, 60
#: The latter where the whole matrix is known: a step is a refinement, and without gain it is at the rounding of the sums.
KNOWN_PATIENCE = 3
#: Vectors of at most so many numbers leave the JVM as plain arrays, or not at all: a struct costs about 20 microseconds a row on the way to Python.
NARROW = 64
#: Up to so many weights stand in the plan of a prediction.
WRITTEN = 1 << 14
#: Numbers in a piece of a long vector, at least.
PIECE = 1 << 17
#: The tasks that make a sum of so many: for each core, or one for so many tasks that the slices lie in.
LONG_WAVES, LONG_SHARE = 2, 8
#: Columns of the matrix that are worked out at once; of a symmetric one only those from the diagonal on are summed.
PANEL = 256
#: Parquet's writer otherwise holds a hundred slices before it looks at their size, and its reader all of a row group.
_SMALL_GROUPS = {"parquet.block.size": str(BATCH_BYTES), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
_SEED = 20_260_101
_SLICES = "n int, starts binary, columns binary, numbers binary, y binary"


def _array(features: str) -> Column:
    """A vector as an array; null stays null."""
    return F.when(F.col(features).isNotNull(), vector_to_array(features))


def to_slices(train: DataFrame, features: str, target: str, width: int | None = None) -> DataFrame:
    """The rows with a target as stored slices. Vectors, sparse or dense, arrive as what they consist of, narrow ones as arrays."""
    narrow = width is not None and width <= NARROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y").to_numpy(zero_copy_only=False)
            for begin, to in _parts(x if narrow else x.field("values")):
                columns, numbers, ends = (_all if narrow else _entries)(x.slice(begin, to - begin))
                parts = [np.append(0, ends).astype("<i8"), columns.astype("<i4"), numbers.astype("<f8"), y[begin:to].astype("<f8")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([to - begin], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], ["n", "starts", "columns", "numbers", "y"]
                )

    x = _array(features) if narrow else F.col(features)
    rows = train.where(F.col(features).isNotNull() & F.col(target).isNotNull()).select(x.alias("x"), F.col(target).cast("double").alias("y"))
    with small_batches(train.sparkSession):
        return stored(rows.where(~F.isnan("y")).mapInArrow(run, _SLICES), "ridge", options=_SMALL_GROUPS)


class Rows:
    """All slices, with sums of vectors over them."""

    def __init__(self, slices: DataFrame) -> None:
        self.slices = slices
        self.tasks = slices.rdd.getNumPartitions()

    def total(self, work: Callable[[Slice], np.ndarray], length: int = 1) -> np.ndarray | None:
        """The sum of ``work`` over all slices: inside tasks, then of groups of tasks, then on the driver.

        Every task writes a sum, so that few tasks make one of a ``length`` that counts.
        """
        slices, tasks = self.slices, self.tasks
        if length >= PIECE:
            few = max(LONG_WAVES * slices.sparkSession.sparkContext.defaultParallelism, tasks // LONG_SHARE)
            if few < tasks:
                slices, tasks = slices.coalesce(few), few
        groups = math.isqrt(tasks)

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for part in _opened(batches):
                own = work(part)
                if total is None:
                    total = own
                else:
                    total += own
            if total is not None:
                pieces = max(1, min(groups, len(total) // PIECE))
                for k, piece in enumerate(np.array_split(total, pieces)):
                    group = k if pieces > 1 else TaskContext.get().partitionId() % groups
                    yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([k], pa.int32()), pa.array([piece.astype("<f8").tobytes()], pa.binary())], ["g", "k", "t"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, data in zip(batch.column("k").to_pylist(), batch.column("t")):
                    own = np.frombuffer(data.as_buffer(), "<f8")
                    if k in totals:
                        totals[k] += own
                    else:
                        totals[k] = own.copy()
            for k, total in totals.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["k", "t"])

        sums = slices.mapInArrow(fold, "g int, k int, t binary")
        if groups > 1:
            sums = sums.repartition(groups, "g").mapInArrow(add, "k int, t binary")
        parts: dict[int, np.ndarray] = {}
        with small_batches(slices.sparkSession):
            found = sums.select("k", "t").collect()
        for r in found:
            own = np.frombuffer(r["t"], "<f8")
            parts[r["k"]] = parts[r["k"]] + own if r["k"] in parts else own
        return np.concatenate([parts[k] for k in sorted(parts)]) if parts else None


def _eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors (columns) and eigenvalues of a positive matrix, of which the upper half is read, the largest first, without those of rounding."""
    values, vectors = np.linalg.eigh(matrix, "U")
    good = np.flatnonzero(values > values[-1] * 1e-14)[::-1]
    return vectors[:, good], values[good]


def _nystroem(product: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvectors (columns) and eigenvalues of a positive matrix from its product with a basis."""
    shift = np.finfo(float).eps * np.linalg.norm(product) or 1e-300
    product = product + shift * basis
    core = basis.T @ product
    values, turn = np.linalg.eigh((core + core.T) / 2)
    good = values > values[-1] * 1e-14
    half = product @ (turn[:, good] / np.sqrt(values[good]))
    vectors, singular, _ = np.linalg.svd(half, full_matrices=False)
    return vectors, np.maximum(singular**2 - shift, 0.0)


def solve_ridge(
    train: DataFrame, features: str, target: str, width: int, alpha: float = 1.0, intercept: bool = True,
    tolerance: float = TOLERANCE, max_steps: int = 2000, sketch_cells: int = SKETCH_CELLS,
) -> tuple[np.ndarray, float, int]:
    """Weights, intercept and the number of steps of least squares with penalty alpha * |w|^2.

    Columns are scaled to unit length for the way, which changes no result: the penalty is scaled with them.
    With ``alpha`` 0 and dependent columns the solution is one of least squares, not unique.
    """
    rows = Rows(to_slices(train, features, target, width))
    first = rows.total(lambda s: np.concatenate([[len(s.y), s.y.sum()], s.transposed(np.ones(len(s.y)), width)]), width)
    if first is None:
        raise ValueError("no training rows")
    n = first[0]
    mean_y, mean = (first[1] / n, first[2:] / n) if intercept else (0.0, np.zeros(width))

    def squares(s: Slice) -> np.ndarray:
        # A column's squared distance from its mean: entries there, and the mean itself where there is none.
        count = np.bincount(s.columns, minlength=width)
        there = np.bincount(s.columns, (s.numbers - mean[s.columns]) ** 2, width)
        residual = s.y - mean_y
        return np.concatenate([there + (len(s.y) - count) * mean**2, s.transposed(residual, width) - mean * residual.sum()])

    second = rows.total(squares, 2 * width)
    diagonal, right = second[:width], second[width:]
    scale = np.sqrt(diagonal + alpha)
    scale[scale == 0] = 1.0
    right = right / scale
    penalty = alpha / scale**2
    shift = mean / scale

    def product(v: np.ndarray) -> np.ndarray:
        w = v / scale
        off = float(shift @ v)

        def one(s: Slice) -> np.ndarray:
            u = s.times(w) - off
            return s.transposed(u, width) - mean * u.sum()

        return rows.total(one, width) / scale

    rank = max(1, min(width, sketch_cells // width))
    whole = rank == width

    panels = [(p, min(p + PANEL, width)) for p in range(0, width, PANEL)]
    cells = sum((to - p) * (width - p) for p, to in panels)

    def gram(s: Slice) -> np.ndarray:
        """The matrix by panels of rows, each from the diagonal on."""
        out = np.zeros(cells)
        block = np.empty((max(1, min(BLOCK_CELLS // width, len(s.y))), width))
        for at in range(0, len(s.y), len(block)):
            starts = s.starts[at : at + len(block) + 1]
            part = slice(int(starts[0]), int(starts[-1]))
            centred = block[: len(starts) - 1]
            centred[:] = -mean / scale
            columns = s.columns[part]
            np.add.at(centred.reshape(-1), np.repeat(np.arange(len(centred)) * width, np.diff(starts)) + columns, s.numbers[part] / scale[columns])
            begin = 0
            for p, to in panels:
                own = centred[:, p:to].T @ centred[:, p:]
                out[begin : begin + own.size] += own.ravel()
                begin += own.size
        return out

    def unpacked(sums: np.ndarray) -> np.ndarray:
        matrix, begin = np.zeros((width, width)), 0
        for p, to in panels:
            size = (to - p) * (width - p)
            matrix[p:to, p:] = sums[begin : begin + size].reshape(to - p, width - p)
            begin += size
        matrix[np.diag_indices(width)] += penalty
        return matrix

    def many(s: Slice) -> np.ndarray:
        out, mass = np.zeros((width, rank)), np.zeros(rank)
        for at in range(0, len(s.y), SKETCH_ROWS):
            starts = s.starts[at : at + SKETCH_ROWS + 1]
            part = slice(int(starts[0]), int(starts[-1]))
            columns, place = np.unique(s.columns[part], return_inverse=True)
            block = np.zeros((len(starts) - 1, len(columns)))  # of the columns that occur in these rows
            np.add.at(block, (np.repeat(np.arange(len(block)), np.diff(starts)), place), s.numbers[part])
            u = block @ scaled[columns] - off
            out[columns] += block.T @ u
            mass += u.sum(axis=0)
        return (out - np.outer(mean, mass)).ravel()

    if whole:
        vectors, values = _eigen(unpacked(rows.total(gram, cells)))
    else:
        basis = np.linalg.qr(np.random.default_rng([_SEED, width]).standard_normal((width, rank)))[0]
        scaled, off = basis / scale[:, None], shift @ basis
        vectors, values = _nystroem(rows.total(many, width * rank).reshape(width, rank) / scale[:, None] + penalty[:, None] * basis, basis)
    floor = np.finfo(float).eps * width * (values[0] if len(values) else 0.0) or 1e-300
    least = max(values[-1] if len(values) else 0.0, floor)

    def precondition(r: np.ndarray) -> np.ndarray:
        along = vectors.T @ r
        known = vectors @ (along / np.maximum(values, floor))
        return known if whole else known + (r - vectors @ along) / least

    w = np.zeros(width)
    residual = right.copy()
    goal = tolerance * np.linalg.norm(right)
    z = precondition(residual)
    direction, old, best = z, residual @ z, (np.inf, w, 0)
    steps = 0
    for steps in range(1, max_steps + 1):
        size = np.linalg.norm(residual)
        if size < best[0]:
            best = (size, w, steps)
        if size <= goal or steps - best[2] > (KNOWN_PATIENCE if whole else PATIENCE) or old <= 0:
            break
        ahead = product(direction) + penalty * direction
        curve = direction @ ahead
        if curve <= 0:
            break
        length = old / curve
        w = w + length * direction
        residual = residual - length * ahead
        z = precondition(residual)
        new = residual @ z
        direction, old = z + (new / old) * direction, new
    weights = best[1] / scale
    return weights, mean_y - float(mean @ weights), steps


class LinearPredictor(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``intercept + weights . features``; a row without features gets null."""

    featuresCol = Param(Params._dummy(), "featuresCol", "column of feature vectors", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column to add", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "a weight for each feature", TypeConverters.toListFloat)
    constant = Param(Params._dummy(), "constant", "the intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", weights=(), constant=0.0):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", weights=[], constant=0.0)
        self._set(**self._input_kwargs)

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.weights))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.constant)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, constant = list(self.getOrDefault(self.weights)), self.intercept
        if len(weights) <= NARROW:
            return self._narrow(dataset, weights, constant)
        if len(weights) <= WRITTEN:
            return self._wide(dataset, weights, constant)
        return self._widest(dataset, np.array(weights), constant)

    def _widest(self, dataset: DataFrame, weights: np.ndarray, constant: float) -> DataFrame:
        def predict(vectors: pa.Array) -> pa.Array:
            sums = np.empty(len(vectors))
            for begin, to in _parts(vectors.field("values")):
                columns, numbers, ends = _entries(vectors.slice(begin, to - begin))
                row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                sums[begin:to] = np.bincount(row, numbers * weights[columns], len(ends)) + constant
            return pa.array(sums, mask=vectors.is_null().to_numpy(zero_copy_only=False))

        # Exploding an array of the one vector keeps the optimiser from moving the vector's own function into this one, where it could not run.
        held = "_vector" + "_" * max(map(len, dataset.columns))
        rows = dataset.withColumn(held, F.explode(F.array(self.getOrDefault(self.featuresCol))))
        return rows.withColumn(self.getOrDefault(self.predictionCol), F.arrow_udf(predict, "double")(held)).drop(held)

    def _wide(self, dataset: DataFrame, weights: list[float], constant: float) -> DataFrame:
        """Entry by entry in the JVM: on their way to Python wide vectors take several times their size outside the heap."""
        held = "_vector" + "_" * max(map(len, dataset.columns))
        known = F.split(F.lit(" ".join(map(repr, weights))), " ").cast("array<double>")  # worked out once, as a constant
        indices, values = F.col(f"{held}.indices"), F.col(f"{held}.values")
        dense = F.transform(values, lambda v, i: v * F.get(known, i))
        sparse = F.transform(indices, lambda i, k: F.get(values, k) * F.get(known, i))
        products = F.when(F.col(f"{held}.type") == 0, sparse).otherwise(dense)
        total = F.aggregate(products, F.lit(0.0), lambda a, b: a + b)
        beyond = F.raise_error(f"a vector has more than the {len(weights)} features the model was fitted on").cast("double")
        found = F.when(F.col(held).isNotNull(), F.coalesce(total, beyond) + F.lit(constant))
        return dataset.withColumn(held, F.unwrap_udt(self.getOrDefault(self.featuresCol))).withColumn(self.getOrDefault(self.predictionCol), found).drop(held)

    def _narrow(self, dataset: DataFrame, weights: list[float], constant: float) -> DataFrame:
        """The same as column expressions, added up in the same order."""
        held = "_vector" + "_" * max(map(len, dataset.columns))
        total = F.lit(0.0)
        for i, weight in enumerate(weights):
            total = total + F.coalesce(F.get(held, F.lit(i)), F.lit(0.0)) * F.lit(weight)
        wide = F.raise_error(f"a vector has more than the {len(weights)} features the model was fitted on").cast("double")
        found = F.when(F.size(held) > len(weights), wide).when(F.col(held).isNotNull(), total + F.lit(constant))
        return dataset.withColumn(held, _array(self.getOrDefault(self.featuresCol))).withColumn(self.getOrDefault(self.predictionCol), found).drop(held)
