"""Near-duplicate vectors by randomised-rotation binary codes with confidence bounds.

A vector x of length 1 is rotated by a random orthogonal matrix and kept as its signs s (one bit for
each dimension) and the correction factor f = <s, x> / sqrt(D). For another vector q,
``<s, q> / (sqrt(D) * f)`` is an unbiased estimate of their cosine with a standard error of about
``sqrt((1 - f^2) / f^2 / (D - 1))``. Only pairs whose estimate plus ``BOUND`` errors reaches the
threshold are recomputed exactly, in double precision.

Candidates come from sign bits of further rotations: ``TABLES`` keys of ``BITS`` bits each; vectors
that agree in one key meet. At cosine 0.98 a bit agrees with probability 1 - acos(0.98) / pi, so 16
tables of 16 bits find 99.9 % of the pairs right at the threshold and more above it. With more than
some millions of vectors for each label raise BITS, and TABLES with them.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows
without a label, link with nothing; so do vectors of different length. Equal vectors of a label are
one class and linked with each other. Repeated vec_ids are rows of their own; null ids link with
nothing. Extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.llm.components import components
from chunkgate.llm.tiles import cells, compare, floats, forest
from chunkgate.sources.tables import stored

THRESHOLD = 0.98
TABLES, BITS = 16, 16
BOUND = 3.5
TILE = 512
_SEED = 20_260_101


@lru_cache(maxsize=64)
def rotation(dims: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([_SEED, dims, number]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def table_keys(x: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """For each vector its key in each table: signs of coordinates of rotations 1, 2, ..."""
    dims = x.shape[1]
    signs = [x @ rotation(dims, 1 + k).T > 0 for k in range(-(-tables * bits // dims))]
    signs = np.concatenate(signs, axis=1)[:, : tables * bits].reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def binary_codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of the rotated vectors, packed, and their correction factors."""
    turned = x @ rotation(x.shape[1], 0).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encode_vectors(classes: DataFrame, tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """The index: for each class its code, factor and table keys beside the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            sizes = np.diff(vectors.offsets.to_numpy())
            for d in np.unique(sizes):
                part = batch.filter(pa.array(sizes == d))
                x = _unit(floats(part.column("embedding")))
                code, factor = binary_codes(x)
                keys = table_keys(x, tables, bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("rep"), part.column("label"), part.column("copies"), part.column("embedding"),
                        pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor),
                        pa.array(list(keys.astype(np.int32)), pa.list_(pa.int32())),
                    ],
                    ["rep", "label", "copies", "embedding", "code", "factor", "keys"],
                )

    return classes.select("rep", "label", "copies", "embedding").mapInArrow(
        run, "rep long, label string, copies long, embedding array<double>, code binary, factor double, keys array<int>"
    )


def _compare_cell(threshold: float, bound: float):
    def kernel(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tile, ids, copies = (rows.column(c).to_numpy() for c in ("tile", "rep", "copies"))
        low, high, table = (rows.column(c)[0].as_py() for c in ("low", "high", "table"))
        keys = floats(rows.column("keys"))
        x = _unit(floats(rows.column("embedding")))
        dims = x.shape[1]
        turned = x @ rotation(dims, 0).T
        codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(x), -1)
        signs = np.unpackbits(codes, axis=1, count=dims).astype(np.float64) * 2 - 1
        factor = np.maximum(rows.column("factor").to_numpy(), 1e-9)
        error = bound * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(dims - 1, 1))
        a, b = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        lefts, rights = [], []
        for k in range(0, len(a), 256):
            own = a[k : k + 256]
            estimate = (signs[own] @ turned[b].T) / (np.sqrt(dims) * factor[own, None])
            maybe = estimate + error[own, None] >= threshold
            if low == high:
                maybe &= own[:, None] < b[None, :]
            for t in range(table):  # a pair that met in an earlier table was counted there
                maybe &= keys[own, t][:, None] != keys[b, t][None, :]
            i, j = np.nonzero(maybe)
            for m in range(0, len(i), 1 << 15):
                p, q = own[i[m : m + (1 << 15)]], b[j[m : m + (1 << 15)]]
                fine = np.einsum("nd,nd->n", x[p], x[q]) >= threshold
                lefts.append(p[fine]), rights.append(q[fine])
        left, right = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (lefts, rights))
        if not len(left):
            return
        links = np.bincount(left, copies[right], len(x)) + np.bincount(right, copies[left], len(x))
        root = forest(len(x), left, right, ids)
        some = np.flatnonzero(links > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(root[some])], ["rep", "links", "root"]
        )

    return kernel


def link_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, bits: int = BITS, bound: float = BOUND, tile: int = TILE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of a table of vec_id, label, embedding."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    able = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists("embedding", lambda c: c != 0)
    )
    rows = rows.withColumn("able", F.coalesce(able, F.lit(False)))
    able_rows = rows.where("able")
    classes = stored(able_rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    index = stored(encode_vectors(classes, tables, bits), "vector-index")
    entries = index.select("rep", F.posexplode("keys").alias("table", "key"), "label", F.size("embedding").alias("dims"))
    entries = entries.select("rep", "table", F.xxhash64("label", "dims", "table", "key").alias("bucket"))
    placed = cells(entries, "bucket", "rep", tile, "vector-buckets")
    found = stored(compare(placed.join(index, "rep"), _compare_cell(threshold, bound), "rep long, links long, root long"), "vector-links")
    parts = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    described = classes.join(links, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("label").alias("l"), F.col("embedding").alias("e"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c"),
    )
    described = stored(described, "vector-results")
    joined = rows.join(described, F.col("able") & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")), "left")
    component = F.coalesce("c", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")
    )
