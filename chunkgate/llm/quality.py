"""Quality rules: gradient-boosted trees over document statistics, in numpy node arrays.

``document_statistics`` counts, ``fit_quality`` grows the trees on a bounded sample of labelled
documents, ``judge_quality`` scores whole tables in one pass and no shuffle.

Defined results: a null or empty text has no words and fails the base rules. Rows with a null or
repeated doc_id are judged one by one. Extra columns are kept; those named like a result are
replaced. Labels that are null, or of one kind only, fit a model that accepts everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.llm.words import IS_BLANK, at_bounds, groups, hash_spans, hash_words, join, sampled_texts, slices, split_words, windows

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: Base rules: at least so many words, and at most so many per cent of them in repeated windows.
MIN_WORDS, MAX_REPEAT = 20, 30
#: The trees are grown on at most so many labelled documents, those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
#: A document stays when its probability of being good is at least this.
KEEP_FROM = 0.3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics that the trees see, with the direction in which quality may move: -1 never up, 0 free.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": 0, "digit_share": 0, "mark_share": 0, "distinct_share": 0, "line_words": 0,
}

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[ord("A") : ord("Z") + 1] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[ord("0") : ord("9") + 1] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b".,;:!?\"'()-")] = True


def repeated_words(h: np.ndarray, first: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """For each word: does it lie in a window whose words are found twice or more in its row?"""
    names, at = windows(h, first, size)
    rows = np.searchsorted(first, at, "right") - 1
    order, begins = groups(join(names, rows.astype(np.uint64)))
    often = np.repeat(np.diff(begins) > 1, np.diff(begins))
    hit = at[order[often]]
    cover = np.zeros(len(h) + 1, np.int32)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + size, -1)
    return np.cumsum(cover[:-1]) > 0


def repeated_lines(words) -> tuple[np.ndarray, np.ndarray]:
    """For each row: lines that equal an earlier line and hold a word, and lines that hold a word."""
    data, bounds = words.data, words.bounds
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([bounds[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([bounds[1:], breaks]), kind="stable")
    held = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end = start[held], end[held]
    row = np.searchsorted(bounds, start, "right") - 1
    order, begins = groups(join(hash_spans(data, start, end), row.astype(np.uint64)))
    again = np.ones(len(start), bool)
    again[order[begins[:-1]]] = False
    n = len(bounds) - 1
    return np.bincount(row[again], minlength=n), np.bincount(row, minlength=n)


def document_statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts and a row of ``FEATURES`` for each text."""
    words = split_words(texts)
    h = hash_words(words)
    lead = (words.data & 0xC0) != 0x80
    n_words = np.diff(words.first)
    dup_lines, lines = repeated_lines(words)
    repeat = at_bounds(repeated_words(h, words.first), words.first)
    base = {
        "n_words": n_words,
        "word_chars": words.per_row(lead & ~IS_BLANK[words.data]),
        "n_symbols": words.per_row(_IS_SYMBOL[words.data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat,
    }
    row = words.rows
    order, begins = groups(join(h, row.astype(np.uint64)))
    distinct = np.bincount(row[order[begins[:-1]]], minlength=len(n_words))
    some, chars = np.maximum(n_words, 1), np.maximum(words.per_row(lead), 1)
    return base, np.column_stack([
        np.log1p(n_words), base["word_chars"] / some, base["n_symbols"] / some, dup_lines / np.maximum(lines, 1),
        repeat / some, words.per_row(_IS_UPPER[words.data]) / chars, words.per_row(_IS_DIGIT[words.data]) / chars,
        words.per_row(_IS_MARK[words.data]) / some, distinct / some, n_words / np.maximum(lines, 1),
    ]).astype(np.float64)


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT * base["n_words"])


@dataclass
class Trees:
    """Boosted trees as node arrays: a leaf points to itself, so every row takes ``depth`` steps in every tree."""

    prior: float = 0.0
    depth: int = 0
    roots: list[int] = field(default_factory=list)
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root, np.int32)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow_trees(
    x: np.ndarray, y: np.ndarray, directions: list[int], rounds: int = 60, depth: int = 4,
    rate: float = 0.2, bins: int = 64, smooth: float = 1.0, min_rows: int = 10,
) -> Trees:
    """Newton boosting of log loss on binned statistics.

    A split on a statistic with a direction is only taken if its leaf values move that way, and
    both sides inherit the middle of the two values as a bound, so the whole model is monotonic.
    """
    if len(y) == 0 or y.min() == y.max():
        return Trees(prior=30.0)
    share = y.mean()
    out = Trees(prior=float(np.log(share / (1 - share))), depth=depth)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    feature, cut, left, right, value = [], [], [], [], []

    def node(v: float) -> int:
        k = len(feature)
        feature.append(0), cut.append(0.0), left.append(k), right.append(k), value.append(v)
        return k

    def weight(g, h):
        return -g / (h + smooth)

    raw = np.full(len(y), out.prior)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        root = node(0.0)
        out.roots.append(root)
        todo = [(root, np.arange(len(y)), -np.inf, np.inf, 0)]
        while todo:
            k, rows, low, high, level = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            v = float(np.clip(weight(gs, hs), low, high))
            value[k] = rate * v
            best = (1e-6, None)
            if level < depth and len(rows) >= 2 * min_rows:
                for j, direction in enumerate(directions):
                    size = len(cuts[j]) + 1
                    b = binned[rows, j]
                    gl = np.cumsum(np.bincount(b, g[rows], size))[:-1]
                    hl = np.cumsum(np.bincount(b, h[rows], size))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=size))[:-1]
                    wl = np.clip(weight(gl, hl), low, high)
                    wr = np.clip(weight(gs - gl, hs - hl), low, high)
                    gain = gl**2 / (hl + smooth) + (gs - gl) ** 2 / (hs - hl + smooth) - gs**2 / (hs + smooth)
                    fine = (nl >= min_rows) & (len(rows) - nl >= min_rows) & ((wr - wl) * direction >= 0)
                    if fine.any():
                        gain = np.where(fine, gain, -np.inf)
                        c = int(gain.argmax())
                        if gain[c] > best[0]:
                            best = (gain[c], (j, c, wl[c], wr[c]))
            if best[1] is None:
                raw[rows] += value[k]
                continue
            j, c, wl, wr = best[1]
            mid = (wl + wr) / 2
            goes_left = binned[rows, j] <= c
            feature[k], cut[k] = j, float(cuts[j][c])
            left[k], right[k] = node(0.0), node(0.0)
            bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[directions[j]]
            todo += [(left[k], rows[goes_left], *bounds[0], level + 1), (right[k], rows[~goes_left], *bounds[1], level + 1)]
    out.feature, out.left, out.right = (np.array(a, np.int32) for a in (feature, left, right))
    out.cut, out.value = np.array(cut), np.array(value)
    return out


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            _, x = document_statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), part.column("quality").cast(pa.int32())], ["x", "quality"])


def fit_quality(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees grown on at most ``sample_rows`` labelled documents; the sample's size bounds what reaches the driver."""
    sample = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    rows = (
        sampled_texts(documents, sample).select("text", "quality")
        .mapInArrow(_labelled, "x array<double>, quality int").toPandas()
    )
    if rows.empty:
        return Trees(prior=30.0)
    x = np.vstack(rows["x"].to_numpy())
    order = np.lexsort(x.T)  # the same trees whatever order the rows come in
    return grow_trees(x[order], rows["quality"].to_numpy(float)[order], list(FEATURES.values()))


RESULTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def judge_quality(documents: DataFrame, trees: Trees, keep_from: float = KEEP_FROM, columns: list[str] | None = None) -> DataFrame:
    """Each document's base counts, base_failed, score and kept, after ``columns`` (all by default).

    One pass over the table; text is kept only if it is among the columns.
    """
    new = [c.split()[0] for c in RESULTS.split(", ")]
    kept = [c for c in (columns if columns is not None else documents.columns) if c not in new]
    needed = documents.select(*dict.fromkeys([*kept, "text"]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                base, x = document_statistics(part.column("text"))
                failed, score = base_failed(base), trees.score(x)
                arrays = [pa.array(base[c].astype(np.int64)) for c in BASE]
                arrays += [pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep_from))]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + arrays, [*kept, *new])

    types = {f.name: f.dataType.simpleString() for f in needed.schema}
    return needed.mapInArrow(judge, ", ".join([f"`{c}` {types[c]}" for c in kept] + [RESULTS]))
