"""Paired bootstrap with exact draws: every replicate draws as many rows as there are.

Drawing n rows with replacement gives the rows multinomial counts. They need no list of drawn indices: rows
lie in a binary tree by the bits of their key's hash, and the draws of a node go to its two halves by a binomial
with the halves' shares of rows, given the draws of the node. So the counts of a replicate add up to n, no
weight is capped, and each task needs only the draws of its own bucket.

The binomial is the inverse of its distribution at a hash of (replicate, node), so partitioning and retries
cannot change a draw, and any engine that knows the formula draws the same. Large groups are cut into buckets
by their first bits; their draws come from a table of bucket counts, at most ``BUCKETS`` of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkgate import defaults
from chunkgate.operators.bootstrap import PRIME, replicate_terms
from chunkgate.sources.tables import stored

HASH_BITS = 60
#: Rows of a bucket at least, and buckets at most.
BUCKET_ROWS, BUCKETS = 2048, 1 << 16
#: Draws (nodes times replicates) that are worked out at once.
DRAWS = 1 << 18
#: Replicates that one task draws for the buckets of a large group.
CHUNK = 64
#: How far from its mean a binomial can lie: so many deviations leave less than a double can tell from 0.
DEVIATIONS = 9


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's md5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("bigint")


# Binomials -----------------------------------------------------------------------------

# The error of Stirling's formula for log(k!), exact for small k: fixed values of log(k!) - log(sqrt(2 pi k)) - k log(k) + k.
_SMALL = np.array([0.0] + [float(np.sum(np.log(np.arange(1, k + 1))) - 0.5 * np.log(2 * np.pi * k) - k * np.log(k) + k) for k in range(1, 16)])


def _stirling(k: np.ndarray) -> np.ndarray:
    x = np.maximum(k, 1.0)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * x * x)) / (x * x)) / (x * x)) / x
    return np.where(k < 16, _SMALL[np.minimum(k, 15).astype(np.int64)], series)


def _deviance(k: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """k log(k / mean) + mean - k, without cancellation where they are close."""
    d = (k - mean) / mean
    with np.errstate(divide="ignore", invalid="ignore"):
        far = np.where(k > 0, k * np.log(np.where(k > 0, k, 1.0) / mean), 0.0) + mean - k
    small = np.abs(d) < 1e-3
    if not small.any():
        return far
    near = mean * (d * d / 2 - d**3 / 6 + d**4 / 12 - d**5 / 20)
    return np.where(small, near, far)


def log_binomial(k: np.ndarray, m: np.ndarray, p: np.ndarray) -> np.ndarray:
    """log of the probability of k among m, accurate for large m (the saddle point form)."""
    q = 1 - p
    rest = m - k
    with np.errstate(divide="ignore", invalid="ignore"):
        inner = _stirling(m) - _stirling(k) - _stirling(rest) - _deviance(k, m * p) - _deviance(rest, m * q) + 0.5 * np.log(m / (2 * np.pi * k * rest))
        out = np.where(k == 0, m * np.log1p(-p), np.where(rest == 0, m * np.log(p), inner))
    return out


def binomials(m: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The smallest k whose distribution function exceeds u, for arrays of one shape and 0 < p < 1."""
    m = m.astype(np.float64)
    out = np.zeros(m.shape)
    spread = DEVIATIONS * np.sqrt(m * p * (1 - p)) + DEVIATIONS
    low = np.maximum(np.floor(m * p - spread), 0.0)
    todo = np.flatnonzero(m > 0)
    k, mt, ut = low[todo], m[todo], u[todo]
    odds = (p / (1 - p))[todo]
    mass = np.exp(log_binomial(k, mt, p[todo]))
    total = mass.copy()
    while len(todo):
        done = (total > ut) | (k >= mt)
        if done.any():
            out[todo[done]] = k[done]
            go = ~done
            todo, k, mt, ut, odds, mass, total = (v[go] for v in (todo, k, mt, ut, odds, mass, total))
            if not len(todo):
                break
        mass = mass * (mt - k) / (k + 1) * odds
        k = k + 1
        total = total + mass
    return out.astype(np.int64)


# The tree ------------------------------------------------------------------------------


def node_hashes(levels: Sequence[int], prefixes: Sequence[int]) -> np.ndarray:
    """Two hashes of each node, a node being the rows whose first ``level`` bits are ``prefix``."""
    out = np.empty((len(levels), 2), np.int64)
    for i, (level, prefix) in enumerate(zip(levels, prefixes)):
        digest = hashlib.md5(f"{level}:{prefix}".encode()).hexdigest()
        out[i] = int(digest[:8], 16) % PRIME, int(digest[8:16], 16) % PRIME
    return out


def split_draws(draws: np.ndarray, left: np.ndarray, right: np.ndarray, hashes: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Draws that go to the left half: ``draws`` has a row for each node and a column for each replicate."""
    a, b, c = terms
    mixed = (hashes[:, :1] * a + hashes[:, 1:] * b + c) % PRIME
    u = (mixed + 0.5) / PRIME
    share = np.broadcast_to((left / (left + right))[:, None], u.shape)
    return binomials(draws.ravel(), share.ravel(), u.ravel()).reshape(u.shape)


def tree_draws(hashes: np.ndarray, rows: np.ndarray, draws: np.ndarray, terms: np.ndarray, width: int = HASH_BITS) -> np.ndarray:
    """The draws of each leaf. ``hashes`` are distinct and sorted, of ``width`` bits; ``rows`` is each leaf's number of
    rows, ``draws`` those of all of them in each replicate."""
    n = len(hashes)
    out = np.zeros((n, len(draws)), np.int64)
    before = np.concatenate([[0], np.cumsum(rows)])
    begin, end, own = np.array([0]), np.array([n]), draws[None, :]
    while len(begin):
        single = end - begin == 1
        out[begin[single]] = own[single]
        begin, end, own = begin[~single], end[~single], own[~single]
        if not len(begin):
            break
        first, last = hashes[begin], hashes[end - 1]
        bit = np.floor(np.log2((first ^ last).astype(np.float64))).astype(np.int64)  # the highest that differs
        bit += (first ^ last) >> (bit + 1) > 0
        bit -= (first ^ last) >> bit == 0
        middle = np.searchsorted(hashes, (last >> bit) << bit)
        left, right = before[middle] - before[begin], before[end] - before[middle]
        names = node_hashes((width - 1 - bit).tolist(), (first >> (bit + 1)).tolist())
        lower = np.empty_like(own)
        step = max(1, DRAWS // max(1, own.shape[1]))
        for at in range(0, len(begin), step):
            part = slice(at, at + step)
            lower[part] = split_draws(own[part], left[part], right[part], names[part], terms)
        begin, end, own = np.concatenate([begin, middle]), np.concatenate([middle, end]), np.concatenate([lower, own - lower])
    return out


# On Spark ------------------------------------------------------------------------------


def _bucket_draws(counts: DataFrame, n_boot: int, terms: np.ndarray) -> DataFrame:
    """(_g, _b, draws): the draws of each bucket of the groups that have several, an array over the replicates.

    A group's counts, at most ``BUCKETS``, are in one row; its replicates are worked out ``CHUNK`` at a time in tasks of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                buckets = sorted((b["_b"], b["n"]) for b in row["buckets"])
                number, rows = np.array(buckets, np.int64).T
                part = terms[:, row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK]
                draws = tree_draws(number, rows, np.full(part.shape[1], rows.sum()), part, row["_bits"])
                size = len(number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, row["_g"])), pa.array(number), pa.array(np.full(size, row["chunk"], np.int32)), pa.array(list(draws), pa.list_(pa.int64()))],
                    ["_g", "_b", "chunk", "draws"],
                )

    chunks = F.explode(F.sequence(F.lit(0), F.lit((n_boot - 1) // CHUNK)))
    groups = counts.where("_bits > 0").groupBy("_g", "_bits").agg(F.collect_list(F.struct("_b", "n")).alias("buckets")).withColumn("chunk", chunks)
    found = groups.repartition("_g", "chunk").mapInArrow(run, "_g long, _b long, chunk int, draws array<long>")
    ordered = F.array_sort(F.collect_list(F.struct("chunk", "draws")))
    return found.groupBy("_g", "_b").agg(F.flatten(F.transform(ordered, lambda c: c["draws"])).alias("draws"))


def bootstrap_sums(errors: DataFrame, key: str, delta: str, n_boot: int = defaults.N_BOOT, seed: int = defaults.GATE_SEED, by: Sequence[str] = ()) -> DataFrame:
    """One row for each replicate (of each group): ``n_draws``, which is the number of rows, and ``delta``, their mean.

    ``key`` is unique; rows whose keys have one hash share its draws evenly. Rows without a key or delta are not drawn.
    """
    if n_boot < 1:
        raise ValueError("n_boot cannot be below 1")
    terms = np.array(replicate_terms(n_boot, seed)).T
    hashed = errors.where(F.col(delta).isNotNull() & F.col(key).isNotNull()).select(
        *by, F.col(delta).cast("double").alias("_d"), key_hash(F.col(key)).alias("_h"), F.xxhash64(F.lit(0), *by).alias("_g")
    )
    hashed = stored(hashed, "bootstrap-rows")
    sizes = stored(hashed.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in by]), "bootstrap-groups")
    per_bucket = max(BUCKET_ROWS, -(-(sizes.agg(F.sum("_n")).first()[0] or 0) // (BUCKETS // 2)))
    bits = F.when(F.col("_n") > per_bucket, F.floor(F.log2(F.col("_n") / per_bucket)) + 1).otherwise(0).cast("int")
    placed = hashed.select("_g", "_h", "_d").join(sizes.select("_g", bits.alias("_bits")), "_g")
    placed = placed.withColumn("_b", F.expr(f"shiftright(_h, {HASH_BITS} - _bits)"))
    counts = stored(placed.groupBy("_g", "_bits", "_b").agg(F.count(F.lit(1)).alias("n")), "bootstrap-buckets")
    draws = stored(_bucket_draws(counts, n_boot, terms), "bootstrap-draws")
    cells = placed.groupBy("_g", "_b").agg(F.collect_list(F.struct("_h", "_d")).alias("rows")).join(draws, ["_g", "_b"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch.column("rows")[k].values
                h, d = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("_h", "_d"))
                own = batch.column("draws")[k]
                own = own.values.to_numpy(zero_copy_only=False) if own.is_valid else np.full(n_boot, len(h))  # the group's only bucket
                names, place = np.unique(h, return_inverse=True)
                n = np.bincount(place)
                mean = np.bincount(place, d) / n
                sums, total = np.empty(n_boot), np.empty(n_boot, np.int64)
                step = max(1, (1 << 22) // len(names))
                for at in range(0, n_boot, step):
                    part = slice(at, at + step)
                    found = tree_draws(names, n, own[part], terms[:, part])
                    sums[part], total[part] = mean @ found, found.sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n_boot, batch.column("_g")[k].as_py())), pa.array(np.arange(n_boot, dtype=np.int32)), pa.array(total), pa.array(sums)],
                    ["_g", "replicate", "n", "total"],
                )

    sums = cells.mapInArrow(run, "_g long, replicate int, n long, total double").groupBy("_g", "replicate").agg(
        F.sum("n").alias("n_draws"), (F.sum("total") / F.sum("n")).alias("delta")
    )
    return sums.join(sizes.select("_g", *by), "_g").select(*by, "replicate", "n_draws", "delta") if by else sums.drop("_g")
