"""Paired Poisson bootstrap of the difference of two mean errors."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkgate import defaults
from chunkgate.functions.keys import hash32
from chunkgate.operators.skew import hot_keys

PRIME = 2**31 - 1
MAX_WEIGHT = 8


def poisson_limits() -> list[int]:
    """Limits on a hash in [0, PRIME): weight w below the w-th limit, Poisson(1) distributed."""
    share, limits = 0.0, []
    for k in range(MAX_WEIGHT):
        share += math.exp(-1) / math.factorial(k)
        limits.append(math.floor(share * PRIME))
    return limits


def replicate_terms(n_boot: int, seed: int) -> list[tuple[int, int, int]]:
    """The factors (a, b, c) of each replicate's hash, from md5(seed:replicate)."""
    terms = []
    for replicate in range(n_boot):
        digest = hashlib.md5(f"{seed}:{replicate}".encode()).hexdigest()
        terms.append(tuple(int(digest[8 * i : 8 * i + 8], 16) % PRIME for i in range(3)))
    return terms


#: Rows and replicates that are drawn together: their hashes stay in a core's cache.
DRAW_ROWS, DRAW_REPLICATES = 2048, 16


def _weights(h1: np.ndarray, h2: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The weight of each row (columns) in each replicate (rows)."""
    m = a[:, None] * h1 + b[:, None] * h2 + c[:, None]  # below 2^63
    # The prime is 2^31 - 1: its multiples of 2^31 count as ones.
    m = (m & PRIME) + (m >> 31)
    m = ((m & PRIME) + (m >> 31)).astype(np.uint32)
    m = np.where(m >= PRIME, m - np.uint32(PRIME), m)
    weight = np.zeros(m.shape, np.uint8)
    for limit in limits:
        weight += m >= limit
    return weight


def _drawn(terms: list[tuple[int, int, int]], by: Sequence[str]):
    """For the rows of a group, or of a part of one, the sums of weights and of weighted differences in each replicate."""
    a, b, c = (np.array(column, np.int64) for column in zip(*terms))
    limits = np.array(poisson_limits(), np.uint32)
    n = len(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sums, given, group = np.zeros(n), np.zeros(n), False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            group = group or [batch.column(x).slice(0, 1) for x in by]
            d, h1, h2 = (batch.column(x) for x in ("_d", "_h1", "_h2"))
            given = given or d.null_count < len(d)
            d = d.fill_null(0.0).to_numpy(zero_copy_only=False)
            no_key = h1.is_null().to_numpy(zero_copy_only=False)
            h1, h2 = (x.fill_null(0).to_numpy(zero_copy_only=False) for x in (h1, h2))
            for at in range(0, len(d), DRAW_ROWS):
                rows = slice(at, at + DRAW_ROWS)
                absent = np.flatnonzero(no_key[rows])
                for r in range(0, n, DRAW_REPLICATES):
                    some = slice(r, r + DRAW_REPLICATES)
                    w = _weights(h1[rows], h2[rows], a[some], b[some], c[some], limits)
                    w[:, absent] = MAX_WEIGHT  # without a key there is no hash below any limit
                    weights[some] += w.sum(axis=1)
                    sums[some] += w @ d[rows]
        if group is None:
            return
        first = pa.array(np.zeros(n, np.int64))
        yield pa.RecordBatch.from_arrays(
            [*[x.take(first) for x in group], pa.array(np.arange(n, dtype=np.int32)), pa.array(weights), pa.array(sums, mask=np.full(n, not given))],
            [*by, "replicate", "_w", "_wd"],
        )

    return run


def _dealt_out(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows spread evenly, those of a small group together.

    Every row becomes n_boot draws, so this cheap shuffle sets how well the costly part
    runs in parallel. A group that lies in one task leaves it as n_boot partial sums;
    the largest groups, known by count, are spread over SALTS tasks each.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not by:
        return rows.repartition(n, "_h1")
    grouped = rows.withColumn("_g", F.xxhash64(*by))
    large = F.broadcast(hot_keys(grouped, "_g"))
    salt = F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod("_h1", "_salts"))
    salted = grouped.join(large, "_g", "left").withColumn("_salt", salt)
    return salted.repartition(n, *by, "_salt").drop("_g", "_salts")


def bootstrap_deltas(
    errors: DataFrame,
    key: str,
    delta: str,
    n_boot: int = defaults.N_BOOT,
    seed: int = defaults.GATE_SEED,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row for each replicate: the weighted mean of ``delta``.

    A row's weight in replicate r is Poisson(1) of the hash (a_r h1 + b_r h2 + c_r)
    mod a prime, h1 and h2 being two halves of md5(key). Both models share the weight
    because ``delta`` is the difference of their errors on that row. Weights depend
    on the key alone, so partitioning and retries cannot change them. Each task
    folds its rows into one partial sum for each replicate before the shuffle.
    """
    if n_boot < 1:
        raise ValueError("n_boot cannot be below 1")
    hashed = errors.select(
        *by,
        F.col(delta).cast("double").alias("_d"),
        (hash32(F.col(key).cast("string"), 0) % PRIME).alias("_h1"),
        (hash32(F.col(key).cast("string"), 1) % PRIME).alias("_h2"),
    )
    run, rows = _drawn(replicate_terms(n_boot, seed), by), _dealt_out(hashed, by)
    schema = T.StructType([*[hashed.schema[c] for c in by], *[T.StructField(c, T.IntegerType() if c == "replicate" else T.DoubleType()) for c in ("replicate", "_w", "_wd")]])
    parts = rows.groupBy(*by, "_salt").applyInArrow(run, schema) if by else rows.mapInArrow(run, schema)
    return parts.groupBy(*by, "replicate").agg((F.sum("_wd") / F.nullif(F.sum("_w"), F.lit(0.0))).alias("delta"))


def bootstrap_ci(
    errors: DataFrame,
    key: str,
    delta: str,
    n_boot: int = defaults.N_BOOT,
    seed: int = defaults.GATE_SEED,
    by: Sequence[str] = (),
    method: str = "poisson",
) -> DataFrame:
    """The 2.5 and 97.5 percentiles of the replicates, one row (or one for each group).

    ``method`` "poisson" weighs rows on their own, "multinomial" draws as many rows as there are.
    ``percentile`` holds the n_boot replicates of a group and nothing that grows
    with the data.
    """
    bounds = F.percentile("delta", F.array(F.lit(0.025), F.lit(0.975)))
    replicates = replicates_by(method)(errors, key, delta, n_boot, seed, by)
    return (
        replicates.groupBy(*by)
        .agg(bounds.alias("_bounds"))
        .select(*by, F.col("_bounds")[0].alias("ci_low"), F.col("_bounds")[1].alias("ci_high"))
    )


def replicates_by(method: str):
    """The function that makes the replicates."""
    from chunkgate.operators.multinomial import bootstrap_sums

    methods = {"poisson": bootstrap_deltas, "multinomial": bootstrap_sums}
    if method not in methods:
        raise ValueError(f"there is no bootstrap {method}; there are {', '.join(sorted(methods))}")
    return methods[method]
