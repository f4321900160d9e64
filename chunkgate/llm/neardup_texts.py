"""Near-duplicate texts: consistent weighted samples of TF-IDF shingles, banded, verified exactly.

A text is the set of its five-word shingles (of all its words, if there are fewer), each weighing its
count times the mean inverse document frequency of its words. Frequencies are counted over all
documents in a fixed number of hashed word buckets, so the table that every task gets has a fixed
size. Improved consistent weighted sampling draws ``SAMPLES`` shingles from a text; two texts draw
the same one with a probability equal to their weighted Jaccard similarity.

Texts with the same words are one class. Classes that agree in a band of samples meet in cells
of bounded size, where all samples are compared; those that agree in ``MAYBE`` of them become
candidates. Texts of a connected set of candidates are compared exactly, all with all, in
cells again, and links of at least ``THRESHOLD`` make the final groups. At similarity 0.8 a pair
misses all 12 bands of 4 with probability 0.2 %, above it less.

Defined results: null, empty and blank texts are linked with nothing. A null doc_id is linked with
nothing. Repeated rows of one id are one document and share its result; if their texts differ, each
text counts. Extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.llm.components import components
from chunkgate.llm.tiles import cells, compare, forest
from chunkgate.llm.words import Words, groups, hash_words, join, mix, slices, split_words, windows
from chunkgate.sources.tables import stored

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
#: Share of equal samples from which a pair is compared exactly: five standard errors below the threshold.
MAYBE = 0.5
#: Hashed buckets of words in which document frequencies are counted.
WORD_BUCKETS = 1 << 18
SAMPLE_TILE, EXACT_TILE = 1024, 256
_U = np.uint64
_SEED = 7_919


def _gamma_table() -> np.ndarray:
    """Values of a Gamma(2, 1) variable at 2**16 evenly spaced probabilities, by bisection."""
    u = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros_like(u), np.full_like(u, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < u
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return mid


_GAMMA = _gamma_table().astype(np.float32)
_LOG_GAMMA = np.log(_GAMMA)
_BETA = ((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
_KEYS = np.random.default_rng(_SEED).integers(1, 1 << 63, (SAMPLES, 2), dtype=np.uint64) * _U(2) + _U(1)


def word_frequencies(documents: DataFrame, buckets: int = WORD_BUCKETS) -> tuple[int, np.ndarray]:
    """How many texts have words, and for each bucket how many of them hold a word of it.

    Each task sends one row for each bucket at most; what the driver gets is as large as the table.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                bucket = hash_words(words) % _U(buckets)
                order, begins = groups(words.rows.astype(np.uint64) * _U(buckets) + bucket)
                found += np.bincount(bucket[order[begins[:-1]]].astype(np.int64), minlength=buckets)
                n += int((np.diff(words.first) > 0).sum())
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"bucket": np.append(some, -1), "n": np.append(found[some], n)})

    rows = documents.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    own = rows[rows["bucket"] >= 0]
    out[own["bucket"].to_numpy()] = own["n"].to_numpy()
    return int(rows.loc[rows["bucket"] < 0, "n"].sum()), out


def bucket_weights(n: int, frequencies: np.ndarray) -> np.ndarray:
    """Inverse document frequency of each bucket, at least 1."""
    return (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float32)


def shingles(words: Words, weights: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all rows, ordered by row and name: name (52 bits), weight of one, count, row."""
    h = hash_words(words)
    total = np.concatenate([[0.0], np.cumsum(weights[(h % _U(len(weights))).astype(np.int64)], dtype=np.float64)])
    names, at = windows(h, words.first, size)
    width = np.full(len(at), size)
    counts = np.diff(words.first)
    for r in np.flatnonzero((counts > 0) & (counts < size)):
        a, b = words.first[r], words.first[r + 1]
        name = h[a : a + 1]
        for k in range(a + 1, b):
            name = join(name, h[k : k + 1])
        names, at, width = np.append(names, name), np.append(at, a), np.append(width, b - a)
    row = np.searchsorted(words.first, at, "right") - 1
    order, begins = groups(row.astype(np.uint64) << _U(52) | names >> _U(12))
    first = order[begins[:-1]]
    # A float32 of the mean, so that the same words weigh the same in every text.
    weight = np.round((total[at[first] + width[first]] - total[at[first]]) / width[first], 3)
    return names[first] >> _U(12), weight, np.diff(begins), row[first]


def draw_samples(names: np.ndarray, weight: np.ndarray, begins: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """Improved consistent weighted sampling: for each run of shingles its ``samples`` draws, as 32-bit names.

    For a shingle of weight S, with r and c from Gamma(2, 1) and b uniform, all by hash:
    t = floor(ln S / r + b), ln y = r (t - b), ln a = ln c - ln y - r; the least a is drawn, as (shingle, t).
    """
    out = np.zeros((len(begins), samples), np.uint32)
    log_s = np.log(weight).astype(np.float32)
    runs = np.diff(np.append(begins, len(names)))
    for k in range(samples):
        z = names * _KEYS[k, 0] + _KEYS[k, 1]
        z ^= z >> _U(32)
        z *= _U(0xD6E8FEB86659FD93)
        z ^= z >> _U(29)
        r = _GAMMA[z >> _U(48)]
        b = _BETA[z & _U(0xFFFF)]
        t = np.floor(log_s / r + b)
        a = _LOG_GAMMA[z >> _U(32) & _U(0xFFFF)] - r * (t - b + 1)
        hits = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, begins), runs))
        first = hits[np.searchsorted(hits, begins)]
        out[:, k] = join(names[first], t[first].astype(np.int64).astype(np.uint64)) >> _U(32)
    return out


def sketch(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, exact (a digest of the words), samples, band names of each text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                names, weight, count, row = shingles(words, weights)
                begins = np.flatnonzero(np.diff(row, prepend=-1))
                if not len(begins):
                    continue
                drawn = draw_samples(names, weight * count, begins)
                bands = np.empty((len(begins), BANDS), np.uint64)
                for k in range(BANDS):
                    name = mix(np.full(len(begins), k, np.uint64))
                    for j in range(k * ROWS, (k + 1) * ROWS):
                        name = join(name, drawn[:, j].astype(np.uint64))
                    bands[:, k] = name
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(row[begins])), pa.array(digests(words)[row[begins]].tolist(), pa.binary()),
                        pa.array([x.tobytes() for x in drawn], pa.binary()), pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())),
                    ],
                    ["doc_id", "exact", "samples", "bands"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return rows.mapInArrow(run, "doc_id long, exact binary, samples binary, bands array<long>")


def digests(words: Words) -> np.ndarray:
    """For each row a digest of its words in their order."""
    h = hash_words(words)
    return np.array([hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() for a, b in zip(words.first[:-1], words.first[1:])], object)


def _compare_samples(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    tile, ids = rows.column("tile").to_numpy(), rows.column("rep").to_numpy()
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    drawn = np.frombuffer(b"".join(rows.column("samples").to_pylist()), np.uint32).reshape(len(ids), -1)
    a, b = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
    lefts, rights = [], []
    for k in range(0, len(a), 256):
        own = a[k : k + 256]
        same = np.zeros((len(own), len(b)), np.uint8)
        for j in range(drawn.shape[1]):
            same += drawn[own, j][:, None] == drawn[b, j][None, :]
        i, j = np.nonzero(same >= MAYBE * drawn.shape[1])
        lefts.append(own[i]), rights.append(b[j])
    left, right = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (lefts, rights))
    root = forest(len(ids), left, right, ids)
    some = np.flatnonzero(root != ids)
    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(root[some])], ["a", "b"])


def similarities(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], block: int = 8192) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of (names, weights, counts).

    A shingle that comes n times is n columns, so the smaller count of two texts is the number of
    columns they share, and sums of shared weights are products of blocks of columns.
    """
    sizes = [int(c.sum()) for _, _, c in rows]
    names = np.concatenate([np.repeat(n, c) for n, _, c in rows])
    copy = np.concatenate([np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c) for _, _, c in rows])
    weight = np.concatenate([np.repeat(w, c) for _, w, c in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    order, begins = groups(join(names, copy.astype(np.uint64)))
    counts = np.diff(begins)
    column = np.empty(len(order), np.int64)
    shared = np.cumsum(counts > 1) - 1
    column[order] = np.repeat(np.where(counts > 1, shared, -1), counts)
    mass = np.bincount(row, weight, len(rows))
    common = np.zeros((len(rows), len(rows)))
    n_columns = int((counts > 1).sum())
    kept = np.flatnonzero(column >= 0)
    kept = kept[np.argsort(column[kept], kind="stable")]
    edges = np.searchsorted(column[kept], np.arange(0, n_columns + block, block))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        own = kept[a:b]
        m = np.zeros((len(rows), min(block, n_columns - k * block)))
        m[row[own], column[own] - k * block] = np.sqrt(weight[own])
        common += m @ m.T
    return common / np.maximum(mass[:, None] + mass[None, :] - common, 1e-300)


def _compare_exactly(threshold: float):
    def kernel(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tile, ids = rows.column("tile").to_numpy(), rows.column("rep").to_numpy()
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        sets = [
            (np.frombuffer(n, np.uint64), np.frombuffer(w, np.float32).astype(np.float64), np.frombuffer(c, np.int32))
            for n, w, c in zip(*(rows.column(x).to_pylist() for x in ("names", "weights", "counts")))
        ]
        near = similarities(sets) >= threshold - 1e-9
        near &= ((tile == low)[:, None] & (tile == high)[None, :])
        left, right = np.nonzero(near)
        some = left != right
        root = forest(len(ids), left[some], right[some], ids)
        out = np.flatnonzero(root != ids)
        yield pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(root[out])], ["a", "b"])

    return kernel


def shingle_sets(documents: DataFrame, members: DataFrame, weights: np.ndarray) -> DataFrame:
    """rep, names, weights, counts of the members' texts. ``members`` has rep, exact and id (a document with that text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                names, weight, count, row = shingles(words, weights)
                same = digests(words) == np.array(part.column("exact").to_pylist(), object)
                begins = np.searchsorted(row, np.arange(part.num_rows + 1))
                out = [(r, begins[r], begins[r + 1]) for r in np.flatnonzero(same)]
                ids = part.column("rep").take(pa.array([r for r, _, _ in out], pa.int64()))
                columns = [names, weight.astype(np.float32), count.astype(np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array([c[a:b].tobytes() for _, a, b in out], pa.binary()) for c in columns]], ["rep", "names", "weights", "counts"]
                )

    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text").join(members, "id")
    return texts.select("rep", "text", "exact").mapInArrow(run, "rep long, names binary, weights binary, counts binary").dropDuplicates(["rep"])


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, component_id (the smallest doc_id of its group), kept, for each document."""
    weights = bucket_weights(*word_frequencies(documents))
    sketches = stored(sketch(documents, weights), "sketches")
    # Each text has a number of its own, fixed when the table is written; no result depends on it.
    classes = sketches.groupBy("exact").agg(F.min("doc_id").alias("id"), F.first("samples").alias("samples"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "text-classes")
    entries = classes.select("rep", F.explode("bands").alias("bucket"))
    placed = cells(entries, "bucket", "rep", SAMPLE_TILE, "text-buckets").join(classes.select("rep", "samples"), "rep")
    candidates = components(compare(placed, _compare_samples, "a long, b long"))
    members = candidates.select(F.col("node").alias("rep"), "component").unionByName(
        candidates.select(F.col("component").alias("rep"), "component").distinct()
    )
    members = stored(members, "members")
    sets = stored(shingle_sets(documents, classes.join(members, "rep", "left_semi").select("rep", "exact", "id"), weights), "shingle-sets")
    placed = cells(members, "component", "rep", EXACT_TILE, "candidate-sets").join(sets, "rep")
    verified = components(compare(placed, _compare_exactly(threshold), "a long, b long"))
    texts = stored(sketches.select("doc_id", "exact").join(classes.select("exact", "rep"), "exact").select("doc_id", "rep"), "texts-of-ids")
    several = stored(texts.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b < last").select("doc_id", "b"), "ids-of-texts")
    if not several.isEmpty():  # texts of one id belong together
        same = texts.join(several, "doc_id").select(F.col("rep").alias("a"), "b")
        verified = components(verified.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(same))
    linked = verified.unionByName(verified.select(F.col("component").alias("node"), "component").distinct())
    least = linked.join(classes.select(F.col("rep").alias("node"), "id"), "node").groupBy("component").agg(F.min("id").alias("least"))
    named = stored(linked.join(stored(least, "least-ids"), "component").select(F.col("node").alias("rep"), "least"), "linked-texts")
    grouped = classes.select("rep", "id").join(named, "rep", "left").select("rep", F.coalesce("least", "id").alias("component"))
    per_row = texts.join(stored(grouped, "text-groups"), "rep").groupBy("doc_id").agg(F.min("component").alias("component"))
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    out = ids.join(per_row, "doc_id", "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those whose group has a smaller id."""
    gone = near_duplicates(documents, threshold).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, documents["doc_id"].cast("long") == F.col("_gone"), "left_anti")
