"""Whitening of embeddings by spectrum slicing.

Entries become integers, so counts, sums and sums of products are exact: each task multiplies
matrices of integers centred at the rounded mean, Spark adds the products up, and one exact
correction for the rounding gives the covariance before its single rounding to double.

The covariance is a matrix of dimension times dimension, however many vectors there are; its leading
eigenvalues are found on the driver. The LDL' factors of the covariance minus a shift have as many
positive pivots as there are eigenvalues above the shift (Sylvester). Bisection of shifts isolates
each wanted eigenvalue in an interval of its own; Rayleigh quotient iteration converges in it, and two
further counts on both sides of the result certify that it is the one with that number. Eigenvalues
that no double between them separates form one cluster, whose vectors are made orthogonal.

Defined results: rows without a vector, with null or non-finite entries, or with entries of 2^43 and
more in size (no exact long) are left out; so are vectors that have not the commonest length. Repeated
vec_ids are rows of their own, null ids stay null. There are as many components as dimensions if these
are fewer. A component whose eigenvalue is zero to working precision has null in ``whitened`` and is left
out of ``identity_error``, which is null if no component is left. A deviation of 39 digits is null.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.llm.vectors import finite, matrices
from chunkgate.sources.tables import stored

COMPONENTS = 8
SCALE, OFFSET = 1024.0, 100_000
_LARGEST = float(1 << 43)
_EXACT, _LONG = 2.0**53, 2.0**63
_NUMBER = pa.decimal128(38, 0)
_EPS = np.finfo(np.float64).eps


# The spectrum of a symmetric matrix ----------------------------------------------------


@dataclass
class Factors:
    """P A P' = L D L' with pivots of one or two rows."""

    order: np.ndarray
    lower: np.ndarray
    pivots: list[tuple[int, np.ndarray]]
    scale: float

    def positive(self) -> int:
        """Eigenvalues above zero. A pivot of two rows always has one of each sign."""
        return sum(1 if len(d) == 2 else int(d[0, 0] > 0) for _, d in self.pivots)

    def solve(self, b: np.ndarray) -> np.ndarray:
        """A \\ b; a vanishing pivot counts as one unit in the last place, as inverse iteration wants it."""
        y = b[self.order].astype(np.float64)
        n = len(y)
        for at, d in self.pivots:
            to = at + len(d)
            y[to:] -= self.lower[to:, at:to] @ y[at:to]
        for at, d in self.pivots:
            if len(d) == 2:
                y[at : at + 2] = np.linalg.solve(d, y[at : at + 2])
            else:
                y[at] /= d[0, 0] if abs(d[0, 0]) > _EPS * self.scale else _EPS * self.scale
        for at, d in reversed(self.pivots):
            to = at + len(d)
            y[at:to] -= self.lower[to:n, at:to].T @ y[to:]
        out = np.empty(n)
        out[self.order] = y
        return out


def factorise(a: np.ndarray) -> Factors:
    """LDL' with the pivoting of Bunch and Kaufman."""
    a = a.copy()
    n = len(a)
    scale = float(np.abs(a).max(initial=0.0)) or 1.0
    lower, order, pivots = np.zeros((n, n)), np.arange(n), []
    share = (1 + np.sqrt(17)) / 8

    def swap(i: int, j: int, done: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            lower[[i, j], :done] = lower[[j, i], :done]
            order[[i, j]] = order[[j, i]]

    k = 0
    while k < n:
        rows = 1
        if k + 1 < n:
            column = np.abs(a[k + 1 :, k])
            r = k + 1 + int(column.argmax())
            most, own = column[r - k - 1], abs(a[k, k])
            if max(own, most) <= _EPS * scale:  # rounding is all that is left of the column
                a[k + 1 :, k] = a[k, k + 1 :] = 0
            elif own < share * most:
                other = np.abs(a[k:, r])
                other[r - k] = 0
                if own * other.max() < share * most**2:
                    if abs(a[r, r]) >= share * other.max():
                        swap(k, r, k)
                    else:
                        swap(k + 1, r, k)
                        rows = 2
        to = k + rows
        d = a[k:to, k:to].copy()
        if rows == 2 or d[0, 0] != 0:
            below = a[to:, k:to]
            factor = np.linalg.solve(d, below.T).T if rows == 2 else below / d[0, 0]
            a[to:, to:] -= factor @ below.T
            lower[to:, k:to] = factor
        pivots.append((k, d))
        k = to
    return Factors(order, lower, pivots, scale)


class Spectrum:
    """Leading eigenpairs of a symmetric matrix, found by counting."""

    def __init__(self, a: np.ndarray) -> None:
        self.a = (a + a.T) / 2
        self.n = len(a)
        self.norm = float(np.abs(self.a).sum(axis=1).max(initial=0.0))
        self.tolerance = 4 * _EPS * self.norm
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        """How many eigenvalues are above the shift."""
        if shift not in self.counts:
            self.counts[shift] = factorise(self.a - shift * np.eye(self.n)).positive()
        return self.counts[shift]

    def isolate(self, k: int) -> tuple[float, float, int, int]:
        """An interval (low, high] with the k-th largest eigenvalue, and the numbers of the first and last eigenvalue in it."""
        wide = self.norm * (1 + 1e-9) + self.tolerance
        self.above(wide), self.above(-wide)
        low = max(s for s, c in self.counts.items() if c >= k)
        high = min(s for s, c in self.counts.items() if c < k and s > low)
        while True:
            first, last = self.above(high) + 1, self.above(low)
            middle = (low + high) / 2
            if first == last or high - low <= self.tolerance or not low < middle < high:
                return low, high, first, last
            if self.above(middle) >= k:
                low = middle
            else:
                high = middle

    def _start(self, k: int, found: np.ndarray) -> np.ndarray:
        v = np.random.default_rng([self.n, k]).standard_normal(self.n)
        return self._apart(v, found)

    @staticmethod
    def _apart(v: np.ndarray, found: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - found.T @ (found @ v)
        return v / np.linalg.norm(v)

    def _inside(self, k: int, low: float, high: float, found: np.ndarray) -> tuple[float, np.ndarray]:
        """The one eigenpair of an interval, its vector kept apart from those found. A result that counts do not certify halves it."""
        while True:
            middle = (low + high) / 2
            near = factorise(self.a - middle * np.eye(self.n))
            v = self._start(k, found)
            for _ in range(3):
                v = self._apart(near.solve(v), found)
            value, best = float(v @ self.a @ v), (np.inf, 0.0, v)
            for _ in range(20):
                residual = float(np.linalg.norm(self.a @ v - value * v))
                if residual >= best[0] or not low - self.tolerance <= value <= high + self.tolerance:
                    break
                best = (residual, value, v)
                v = self._apart(factorise(self.a - value * np.eye(self.n)).solve(v), found)
                value = float(v @ self.a @ v)
            if best[0] < np.inf and self.certified(k, best[1]):
                return best[1], best[2]
            if not low < middle < high:
                raise ArithmeticError(f"no vector is found for eigenvalue {k}")
            if self.above(middle) >= k:
                low = middle
            else:
                high = middle

    def certified(self, k: int, value: float) -> bool:
        """Whether counts on both sides of the value agree that it is the k-th largest."""
        room = (self.tolerance + _EPS * abs(value)) * max(4, np.sqrt(self.n))
        return self.above(value + room) < k <= self.above(value - room)

    def leading(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k largest eigenvalues, falling, and their unit vectors as rows."""
        k = min(k, self.n)
        if not self.norm:
            return np.zeros(k), np.eye(self.n)[:k]
        values, vectors = [], np.zeros((0, self.n))
        while len(values) < k:
            number = len(values) + 1
            low, high, first, last = self.isolate(number)
            if last == first:
                pairs = [self._inside(number, low, high, vectors)]
            else:  # equal for a double: any orthogonal vectors of their space will do
                pairs, near = [], factorise(self.a - ((low + high) / 2) * np.eye(self.n))
                for m in range(number, last + 1):
                    before = np.vstack([vectors, *[v for _, v in pairs]])
                    v = self._start(m, before)
                    for _ in range(4):
                        v = self._apart(near.solve(v), before)
                    pairs.append((float(v @ self.a @ v), v))
                pairs.sort(key=lambda pair: -pair[0])
                wrong = [value for m, (value, _) in enumerate(pairs, number) if not self.certified(m, value)]
                if wrong:
                    raise ArithmeticError(f"counts do not certify {wrong} from eigenvalue {number}")
            values += [value for value, _ in pairs]
            vectors = np.vstack([vectors, *[v for _, v in pairs]])
        return np.array(values[:k]), vectors[:k]


# Exact sums over the vectors -----------------------------------------------------------


def _decimals(numbers: np.ndarray) -> pa.Array:
    """Integers (of any size, as objects) as decimals; null where 38 digits do not hold them."""
    return pa.array([Decimal(int(v)) if abs(int(v)) < 10**38 else None for v in numbers], _NUMBER)


def scaled(c: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000, exact in a double for entries below 2^43."""
    return np.floor(SCALE * c) + OFFSET


def _sums(vector: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Count and sum of each position, apart for each length of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            sizes = np.diff(batch.column(vector).offsets.to_numpy())
            for d in np.unique(sizes):
                part = batch if (sizes == d).all() else batch.filter(pa.array(sizes == d))
                for _, c in matrices(iter([part]), vector):
                    x = scaled(c)
                    fits = np.abs(x).max() * len(x) < _LONG / 2
                    own = x.astype(np.int64).sum(axis=0).astype(object) if fits else np.array([sum(map(int, v)) for v in x.T], object)
                    n, before = totals.get(int(d), (0, np.zeros(d, object)))
                    totals[int(d)] = (n + len(x), before + own)
        for d, (n, total) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)), _decimals(total)],
                ["dims", "i", "n", "total"],
            )

    return run


def _products(vector: str, centre: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of products of the centred entries, i <= j."""
    dims = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for _, c in matrices(batches, vector):
            d = scaled(c) - centre
            most = float(np.abs(d).max()) ** 2 * len(d)
            if most < _EXACT:
                own = (d.T @ d).astype(np.int64)
            elif most < _LONG:
                own = d.astype(np.int64).T @ d.astype(np.int64)
            else:
                own = d.astype(np.int64).astype(object).T @ d.astype(np.int64).astype(object)
            total += own.astype(object)
        i, j = np.triu_indices(dims)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _decimals(total[i, j])], ["i", "j", "total"])

    return run


@dataclass
class Whitening:
    """What whitening needs to know of the fit list: bounded by the dimension alone."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The mean, rounded to integers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.float64)

    @property
    def explained(self) -> list[float | None]:
        return [float(v) / self.trace if self.trace else None for v in self.values]

    @property
    def useful(self) -> np.ndarray:
        return self.values > len(self.sums) * _EPS * max(float(self.values.max(initial=0.0)), 0.0)


def vector_rows(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (as doubles) of the rows that count."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(finite("embedding", _LARGEST) & (F.size("embedding") > 0))


def exact_covariance(rows: DataFrame, dims: int, n: int, sums: list[int]) -> np.ndarray:
    """The covariance with divisor n: exact integers, rounded once."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    partial = rows.where(F.size("embedding") == dims).select("embedding").mapInArrow(
        _products("embedding", np.array(centre, np.float64)), "i int, j int, total decimal(38,0)"
    )
    out = np.zeros((dims, dims))
    for row in partial.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():  # dims * dims rows
        i, j = row["i"], row["j"]
        out[i, j] = out[j, i] = (n * int(row["total"]) - rest[i] * rest[j]) / (n * n)
    return out


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all ``vector_rows``; None if there are none."""
    sums = rows.select("embedding").mapInArrow(_sums("embedding"), "dims int, i int, n long, total decimal(38,0)")
    sums = stored(sums.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "whitening-sums")
    most = sums.where("i = 0").orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return None
    n, dims = most["n"], most["dims"]
    found = [int(r["total"]) for r in sums.where(F.col("dims") == dims).orderBy("i").collect()]
    covariance = exact_covariance(rows, dims, n, found)
    values, vectors = Spectrum(covariance).leading(components)
    return Whitening(n, found, values, vectors, float(np.trace(covariance)))


def _project(fit: Whitening) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    n, centre, useful = fit.n, fit.centre, fit.useful
    rest = [s - n * int(c) for s, c in zip(fit.sums, centre)]
    shift = np.array([r / n for r in rest])
    axes = fit.vectors / np.sqrt(np.where(useful, fit.values, 1.0))[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, c in matrices(batches, "embedding"):
            d = scaled(c) - centre
            largest = float(np.abs(d).max()) * n + max(map(abs, rest))
            if largest**2 * len(centre) < _LONG / 2:
                far = pa.array(((d.astype(np.int64) * n - np.array(rest, np.int64)) ** 2).sum(axis=1)).cast(_NUMBER)
            else:
                far = _decimals(((d.astype(np.int64).astype(object) * n - np.array(rest, object)) ** 2).sum(axis=1))
            w = (d - shift) @ axes.T
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel(), mask=np.tile(~useful, len(w)))
            )
            yield pa.RecordBatch.from_arrays([piece.column("vec_id"), far, lists], ["vec_id", "deviation", "whitened"])

    return run


def whitened_vectors(rows: DataFrame, fit: Whitening) -> DataFrame:
    """vec_id, deviation (decimal) and all components of each row as ``whitened`` (array)."""
    own = rows.where(F.size("embedding") == len(fit.sums))
    return own.mapInArrow(_project(fit), "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(projected: DataFrame, useful: np.ndarray) -> float | None:
    """Largest entry of the whitened covariance minus the identity; each covariance is merged from centred parts."""
    kept = [int(k) for k in np.flatnonzero(useful)]
    pairs = [(i, j) for i in kept for j in kept if i <= j]
    if not pairs:
        return None
    at = F.col("whitened")
    row = projected.agg(*[F.covar_pop(at[i], at[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = vector_rows(vectors)
    fit = fit_whitening(rows, components)
    if fit is None:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        )
    projected = stored(whitened_vectors(rows, fit), "whitened")
    error = identity_error(projected, fit.useful)
    long = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    explained = F.array(*[F.lit(e).cast("double") for e in fit.explained])
    return long.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
