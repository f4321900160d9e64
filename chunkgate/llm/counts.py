"""Token counts that follow edits: a segment tree over each document's pre-tokens.

A text is cut into leaves of some hundred characters at safe places: before a single blank with no
white space on either side. There every pre-token of a byte-level vocabulary begins anew whatever
stands before or after, so counts of leaves add up to the count of the text. What is kept of a
document are characters and tokens of its leaves; the sums over them (heaps, root at 1) are made
from these when edits arrive.

An edit finds its leaves by going down the tree, splices their texts, takes in a neighbour as long as
the border to it is no safe place any more, re-encodes this region alone and updates the sums above.

Defined results: null and empty texts have one empty leaf and no tokens; edits to them work like
others. Positions count characters of the text as the edits before left it; those outside are moved
to its ends, a null position is 0, a null removal removes nothing, a null insertion is empty. Edits
apply by ``seq``, then by position. Edits to unknown documents are left out. Edits that name a row
(``key``, see ``row_key``) go to the rows with that id and text alone, each edit of a seq once; edits that name an
id go to every row of that id, null ids to null ids. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkgate.llm.tokens import Encoder, encoder
from chunkgate.llm.words import slices

#: A leaf ends at the first safe place after so many characters.
LEAF_CHARS = 256


def safe_place(text: str, i: int) -> bool:
    return 0 < i < len(text) - 1 and text[i] == " " and not text[i - 1].isspace() and not text[i + 1].isspace()


def cut(text: str, size: int = LEAF_CHARS) -> list[str]:
    """The leaves of a text: at least one, all but the first begin with a blank."""
    out, begin, at = [], 0, size
    while at < len(text):
        at = text.find(" ", at)
        if at < 0:
            break
        if safe_place(text, at):
            out.append(text[begin:at])
            begin, at = at, at + size
        else:
            at += 1
    return [*out, text[begin:]]


def heap(values: np.ndarray) -> np.ndarray:
    """Sums over pairs, pairs of pairs, ...: node k has children 2k and 2k + 1."""
    size = 1 << max(0, len(values) - 1).bit_length()
    out = np.zeros(2 * size, np.int64)
    out[size : size + len(values)] = values
    while size > 1:
        out[size // 2 : size] = out[size : 2 * size : 2] + out[size + 1 : 2 * size : 2]
        size //= 2
    return out


class SegmentTree:
    """The leaves of one document and the sums over them."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray) -> None:
        """``chars`` and ``tokens`` are those of the leaves."""
        self.chars, self.tokens = heap(chars), heap(tokens)
        self.size = len(self.chars) // 2
        ends = np.cumsum(chars).tolist()
        self.leaves = [text[a:b] for a, b in zip([0, *ends], ends)] + [""] * (self.size - len(ends))
        self.encoded = 0

    def kept(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the leaves that hold text (of one at least)."""
        chars, tokens = self.chars[self.size :], self.tokens[self.size :]
        some = np.flatnonzero(chars) if self.chars[1] else np.zeros(1, np.int64)
        return chars[some], tokens[some]

    def leaf_at(self, pos: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one for the end), and where in the leaf it is."""
        k = 1
        while k < self.size:
            k *= 2
            if pos >= self.chars[k] and self.chars[k + 1]:
                pos -= int(self.chars[k])
                k += 1
        return k - self.size, pos

    def edit(self, pos: int, removed: int, inserted: str, code: Encoder) -> None:
        total = int(self.chars[1])
        pos = min(max(pos, 0), total)
        removed = min(max(removed, 0), total - pos)
        a, inside = self.leaf_at(pos)
        b = self.leaf_at(pos + removed)[0]
        region = "".join(self.leaves[a : b + 1])
        region = region[:inside] + inserted + region[inside + removed :]
        # Take in neighbours until both borders are safe; leaves without characters are no neighbours.
        while a > 0 and (not region or not self._safe(self._last(a), region)):
            a -= 1
            region = self.leaves[a] + region
        while b + 1 < self.size and self._next(b) and (not region or not self._safe(region, self._next(b))):
            b += 1
            region += self.leaves[b]
        parts = cut(region)
        slots = b - a + 1
        if len(parts) > slots:
            parts = [*parts[: slots - 1], "".join(parts[slots - 1 :])]
        parts += [""] * (slots - len(parts))
        self.leaves[a : b + 1] = parts
        self.encoded += len(region)
        _, tokens = code.encode(parts)
        for heap_, values in ((self.chars, [len(x) for x in parts]), (self.tokens, tokens)):
            heap_[self.size + a : self.size + b + 1] = values
            low, high = self.size + a, self.size + b
            while low > 1:
                low, high = low // 2, high // 2
                heap_[low : high + 1] = heap_[2 * low : 2 * high + 2 : 2] + heap_[2 * low + 1 : 2 * high + 2 : 2]

    def _last(self, a: int) -> str:
        """Text before leaf a, its nearest characters."""
        return next((x for x in reversed(self.leaves[:a]) if x), "")

    def _next(self, b: int) -> str:
        return next((x for x in self.leaves[b + 1 :] if x), "")

    @staticmethod
    def _safe(left: str, right: str) -> bool:
        return not left or safe_place(left[-1] + right[:2], 1)


def build_trees(documents: DataFrame, vocabulary: str) -> DataFrame:
    """_key, n_tokens and the characters and tokens of each text's leaves: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                leaves = [cut(x or "") for x in part.column("text").to_pylist()]
                _, tokens = code.encode([y for x in leaves for y in x])
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
                total = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])
                sizes = np.array([len(y) for x in leaves for y in x], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), pa.array(total[bounds[1:]] - total[bounds[:-1]]), _lists(bounds, sizes), _lists(bounds, np.asarray(tokens, np.int32))],
                    ["_key", "n_tokens", "chars", "tokens"],
                )

    keyed = documents.select(row_key().alias("_key"), "text")
    return keyed.mapInArrow(run, "_key long, n_tokens long, chars array<int>, tokens array<int>")


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """What names a row among edits: its id and text."""
    return F.xxhash64(doc_id, text)


EDITED = "doc_id long, text string, n_tokens_before long, n_tokens long, n_chars long, n_reencoded long, chars array<int>, tokens array<int>"


def apply_edits(documents: DataFrame, trees: DataFrame, edits: DataFrame, vocabulary: str) -> DataFrame:
    """The edited texts with their counts and leaves. ``edits`` has key (or doc_id), seq, pos, removed, inserted."""
    by_row = "key" in edits.columns
    change = F.struct(F.coalesce(F.col("pos").cast("long"), F.lit(0)).alias("pos"), F.coalesce(F.col("removed").cast("long"), F.lit(0)).alias("removed"), F.coalesce("inserted", F.lit("")).alias("inserted"))
    if by_row:  # equal rows bring equal edits
        named = edits.groupBy(F.col("key").cast("long").alias("_to"), "seq").agg(F.min(change).alias("change"))
    else:
        named = edits.select(F.col("doc_id").cast("long").alias("_to"), "seq", change.alias("change"))
    ordered = named.groupBy("_to").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "change"))), lambda e: e["change"]).alias("edits"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("_key"))
    state = rows.select("_key", "doc_id").distinct().join(trees.dropDuplicates(["_key"]), "_key")
    target = state["_key"] if by_row else state["doc_id"]
    state = state.join(ordered, target.eqNullSafe(ordered["_to"]), "left").drop("_to", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                texts, edits = part.column("text").to_pylist(), part.column("edits").to_pylist()
                bounds = part.column("chars").offsets.to_numpy()
                bounds = bounds - bounds[0]
                chars, tokens = (part.column(c).flatten().to_numpy().astype(np.int64) for c in ("chars", "tokens"))
                out, kept = [], []
                for k, text in enumerate(texts):
                    own = slice(bounds[k], bounds[k + 1])
                    tree = SegmentTree(text or "", chars[own], tokens[own])
                    for e in edits[k] or []:
                        tree.edit(e["pos"], e["removed"], e["inserted"], code)
                    out.append(("".join(tree.leaves), int(tree.tokens[1]), int(tree.chars[1]), tree.encoded))
                    kept.append(tree.kept())
                new, n_tokens, n_chars, encoded = zip(*out)
                ends = np.concatenate([[0], np.cumsum([len(c) for c, _ in kept])])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(new, pa.string()), part.column("n_tokens"), *[pa.array(v, pa.int64()) for v in (n_tokens, n_chars, encoded)],
                        *[_lists(ends, np.concatenate(side).astype(np.int32)) for side in zip(*kept)],
                    ],
                    schema=_EDITED,
                )

    return rows.join(state, "_key").select("doc_id", "text", "n_tokens", "chars", "tokens", "edits").mapInArrow(run, EDITED)


_EDITED = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.string()), ("n_tokens_before", pa.int64()), ("n_tokens", pa.int64()), ("n_chars", pa.int64()),
    ("n_reencoded", pa.int64()), ("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32())),
])
