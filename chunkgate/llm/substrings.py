"""Passages that an earlier document has too, found by recompression.

Words are renamed in rounds, the same way in every document: round 0 gives each run of one word a
name, each later round deals all symbols into left and right ones by a bit of their name and gives
each pair (left, right) a name. Names are 64-bit hashes of what they stand for, so equal substrings
get equal symbols in their interior wherever they are, without a shuffle; only at their ends does the
parse depend on what stands outside. Every symbol carries the stretch of words that its existence
depends on. A symbol whose stretch lies inside a window of 13 words is thus a function of the
window's words alone. The longest of them (by hash among equals) is the window's anchor.

1. The anchors of all windows, a few for each ten words, are grouped: which are in two documents?
2. Windows with such an anchor, and only they, are grouped by the name of their 13 words, a symbol of
   doubled pairs. The first step's answer reaches the tasks as a bit map of fixed size; where that
   is crowded, more windows come through and the result is the same.
3. A window that a document with a smaller id has too marks its 13 words.

What a slice of texts sends is combined and packed before the shuffle. Of a window that is common in
the slice only the smallest doc_id is sent to its bucket, so no bucket holds a group of copies; such
windows' rows are joined afterwards, a run of windows at a time, in a join that adaptive execution
can split.

Defined results: null, empty and blank texts have no words. Rows with a null doc_id lose nothing and
take nothing from others. Documents with equal ids don't count as earlier than each other. Repeated
rows get equal results. Extra columns are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.llm.tiles import compare
from chunkgate.llm.words import Words, groups, hash_words, join, mix, slices, split_words, windows
from chunkgate.sources.tables import stored

WINDOW = 13
PAIR_ROUNDS = 4
#: Bits of the map of shared anchors (16 MB).
MAP_BITS = 1 << 27
#: A window that more rows of a slice have takes the way for common windows.
HOT_ROWS = 8
#: Windows in a run of common windows, on average.
RUN = 16
_U = np.uint64
_NONE = _U(0xFFFFFFFFFFFFFFFF)


def parse(h: np.ndarray, first: np.ndarray, rounds: int = PAIR_ROUNDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each round its symbols: name, number of words, and the stretch of words (begin, end) it depends on.

    Symbols at the ends of a document depend on what isn't there; their stretch is longer than any window.
    """
    n = len(h)
    if not n:
        return []
    far = 1 << 20
    row_start = np.zeros(n, bool)
    row_start[first[:-1][first[:-1] < n]] = True
    # Round 0: runs.
    head = row_start.copy()
    head[1:] |= h[1:] != h[:-1]
    at = np.flatnonzero(head)
    size = np.diff(np.append(at, n))
    name = np.where(size > 1, join(h[at], size.astype(_U)), h[at])
    opens = row_start[at]
    closes = np.append(opens[1:], True)
    begin = np.where(opens, at - far, at - 1)
    end = np.where(closes, at + size + far, at + size + 1)
    out = [(name, size, begin, end)]
    for k in range(1, rounds + 1):
        right = mix(name ^ _U(k * 0x9E37)) >> _U(63) == 1
        fits = ~right[:-1] & right[1:] & ~opens[1:]
        pairs = np.append(fits, False)
        second = np.append(False, fits)
        # A left symbol alone depends on the next one, a right symbol alone on the one before.
        next_end, last_begin = np.append(end[1:], 0), np.append(0, begin[:-1])
        lone = ~pairs & ~second
        end = np.where(pairs, next_end, np.where(lone & ~right, np.where(closes, end + far, next_end), end))
        begin = np.where(lone & right, np.where(opens, begin - far, last_begin), begin)
        # What the stretches of both neighbours cover lies side by side, so their union is one stretch.
        name = np.where(pairs, join(name, np.append(name[1:], _U(0))), name)
        size = np.where(pairs, size + np.append(size[1:], 0), size)
        closes = np.where(pairs, np.append(closes[1:], True), closes)
        kept = ~second
        name, size, begin, end, opens, closes = (a[kept] for a in (name, size, begin, end, opens, closes))
        out.append((name, size, begin, end))
    return out


def anchors(h: np.ndarray, first: np.ndarray, at: np.ndarray, names: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The anchor of each window (which begins at word ``at`` and has the name ``names``)."""
    n = len(h)
    best = {}
    for name, size, begin, end in parse(h, first):
        reach = end - begin
        for width in range(1, window + 1):
            some = np.flatnonzero(reach == width)
            if not len(some):
                continue
            # Longer symbols first, then by name: the smallest key is the anchor.
            key = (_U(15) - np.minimum(size[some], 15).astype(_U)) << _U(60) | name[some] >> _U(4)
            slot = best.setdefault(width, np.full(n, _NONE))
            order = np.argsort(key)[::-1]  # of symbols that begin at one place the smallest key is written last
            where = begin[some][order]
            slot[where] = np.minimum(slot[where], key[order])
    inside = np.full(n, _NONE)
    for width in range(1, window + 1):
        wider = np.minimum(inside, np.append(inside[1:], _NONE))
        inside = np.minimum(wider, best[width]) if width in best else wider
    found = inside[at]
    return np.where(found == _NONE, names, found)


def _windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, first word and anchor of every window."""
    h = hash_words(words)
    names, at = windows(h, words.first, WINDOW)
    return names, at, anchors(h, words.first, at, names)


def _buckets(documents: DataFrame) -> int:
    """A power of two, at least the session's number of shuffle partitions."""
    return 1 << max(4, (int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def _bucket(name: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(name.copy()) >> _U(64 - (buckets.bit_length() - 1))).astype(np.int64)


def _place(anchor: np.ndarray) -> np.ndarray:
    """Places in the map; a bucket owns a stretch of them."""
    return mix(anchor.copy()) >> _U(64 - (MAP_BITS.bit_length() - 1))


def _tagged(documents: DataFrame) -> DataFrame:
    """With 15 bits of the text's hash, which tell rows with one doc_id apart."""
    return documents.withColumn("_tag", F.pmod(F.xxhash64("text"), F.lit(1 << 15)).cast("int"))


def _planes(values: np.ndarray) -> bytes:
    """Integers as planes of their bytes, so that shuffles and files compress the high ones away."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def _from_planes(blobs: list[bytes], kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(size, -1).T).view(kind).reshape(-1) for x in blobs if x]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """The columns' entries of each bucket, in their order, as bytes."""
    order, begins = groups(bucket)
    columns = [c[order] for c in columns]
    for a, b in zip(begins[:-1], begins[1:]):
        yield int(bucket[order[a]]), [_planes(c[a:b]) for c in columns]


def anchor_map(rows: DataFrame, buckets: int) -> np.ndarray:
    """A bit for each place that an anchor falls on which documents with different ids have.

    As large at every size of the corpus. A slice of texts sends an anchor with its smallest and
    largest doc_id only, packed by bucket; the bucket's task returns its stretch of the map.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                _, at, anchor = _windows(words)
                doc = part.column("doc_id").to_numpy()[np.searchsorted(words.first, at, "right") - 1]
                order = np.lexsort((doc, anchor))
                anchor, doc = anchor[order], doc[order]
                ends = np.append(anchor[1:] != anchor[:-1], True) if len(anchor) else np.zeros(0, bool)
                begins = np.append(True, ends[:-1]) if len(anchor) else ends
                last = np.zeros(len(anchor), bool)
                last[ends] = doc[ends] != doc[begins]
                some = begins | last
                sent = list(_by_bucket(_bucket(anchor[some], buckets), anchor[some], doc[some]))
                yield pa.RecordBatch.from_pydict(
                    {"cell": [k for k, _ in sent], "anchors": [x[0] for _, x in sent], "docs": [x[1] for _, x in sent]}, schema=_ANCHORS
                )

    def find(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        anchor = _from_planes(cell.column("anchors").to_pylist(), np.uint64)
        doc = _from_planes(cell.column("docs").to_pylist(), np.int64)
        order, begins = groups(anchor)
        doc = doc[order]
        shared = np.minimum.reduceat(doc, begins[:-1]) < np.maximum.reduceat(doc, begins[:-1])
        k = cell.column("cell")[0].as_py()
        size = MAP_BITS // buckets
        own = np.zeros(size, np.uint8)
        own[_place(anchor[order[begins[:-1][shared]]]).astype(np.int64) - k * size] = 1
        yield pa.RecordBatch.from_pydict({"cell": [k], "bits": [np.packbits(own, bitorder="little").tobytes()]})

    sent = rows.select("doc_id", "text").mapInArrow(send, "cell long, anchors binary, docs binary")
    out = np.zeros((buckets, MAP_BITS // buckets // 8), np.uint8)
    for row in compare(sent, find, "cell long, bits binary").toLocalIterator():
        out[row["cell"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1).view(np.uint64)


_ANCHORS = pa.schema([("cell", pa.int64()), ("anchors", pa.binary()), ("docs", pa.binary())])
_BLOBS = ("names", "docs", "tags", "places")
_WINDOWS = pa.schema([("cell", pa.int64()), *((c, pa.binary()) for c in _BLOBS), ("kind", pa.int32())])
#: What a row of packed entries holds: windows, the smallest doc_id of common windows, runs of rows, windows of runs, marked windows.
_OWN, _LOW, _RUN, _PART, _MARK = range(5)
_FOUND = pa.schema([
    ("kind", pa.int32()), ("name", pa.int64()), ("run", pa.int64()), ("doc_id", pa.int64()), ("_tag", pa.int32()), ("place", pa.int32()),
    ("cell", pa.int64()), *((c, pa.binary()) for c in _BLOBS[1:]),
])


def repeated_windows(documents: DataFrame) -> DataFrame:
    """doc_id, _tag, places: for each row the first words of its windows that a smaller doc_id has too.

    Windows with a shared anchor are sent to the bucket of their name, packed, with row and place. Of
    a window that more than ``HOT_ROWS`` rows of a slice have, only the smallest doc_id goes there.
    Its rows go another way, dealt out evenly: neighbouring common windows form runs, which end after
    every window with a certain hash, so that copies have the same runs. The windows of a run are
    looked up once for each run, and rows are joined with runs, not with windows.
    """
    rows = _tagged(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).where("doc_id is not null")
    buckets = _buckets(documents)
    seen = documents.sparkSession.sparkContext.broadcast(anchor_map(rows, buckets))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = seen.value
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                names, at, anchor = _windows(words)
                place = _place(anchor)
                some = np.flatnonzero(bits[place >> _U(6)] >> (place & _U(63)) & _U(1))
                if not len(some):
                    continue
                name, at = names[some], at[some]
                row = np.searchsorted(words.first, at, "right") - 1
                doc, tag = part.column("doc_id").to_numpy()[row], part.column("_tag").to_numpy()[row].astype(np.int16)
                inside = (at - words.first[row]).astype(np.int32)
                hot = _common(name, row)
                yield _packed(_by_bucket(_bucket(name[~hot], buckets), name[~hot], doc[~hot], tag[~hot], inside[~hot]), _OWN)
                if not hot.any():
                    continue
                name, doc, tag, inside, row = (c[hot] for c in (name, doc, tag, inside, row))
                order = np.lexsort((doc, name))
                least = order[np.append(True, name[order][1:] != name[order][:-1])]
                yield _packed(_by_bucket(_bucket(name[least], buckets), name[least], doc[least]), _LOW)
                begins, offset, run = _runs(name, row, inside)
                dealt = _bucket(join(doc[begins].view(np.uint64), run), buckets)
                yield _packed(_by_bucket(dealt, run, doc[begins], tag[begins], inside[begins]), _RUN)
                _, first = np.unique(run, return_index=True)
                sizes = np.diff(np.append(begins, len(name)))[first]
                parts = np.repeat(begins[first] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                of = np.repeat(run[first], sizes)
                dealt = _bucket(join(of, name[parts]), buckets)
                yield _packed(_by_bucket(dealt, name[parts], of.view(np.int64), tag[parts], offset[parts]), _PART)

    sent = rows.mapInArrow(send, "cell long, names binary, docs binary, tags binary, places binary, kind int")
    schema = "kind int, name long, run long, doc_id long, _tag int, place int, cell long, docs binary, tags binary, places binary"
    found = stored(compare(sent, _search(buckets), schema), "windows", ["kind"])
    gathered = compare(found.where(F.col("kind") == _MARK).select("cell", "docs", "tags", "places"), _gather, "doc_id long, _tag int, places array<int>")
    low = found.where(F.col("kind") == _LOW).select("name", F.col("doc_id").alias("low"))
    parts = found.where(F.col("kind") == _PART).select("run", "place", "name").distinct().join(low, "name")
    lows = stored(parts.groupBy("run").agg(F.collect_list(F.struct("place", "low")).alias("lows")), "runs")
    late = found.where(F.col("kind") == _RUN).select("run", "doc_id", "_tag", "place").join(lows, "run").select(
        "doc_id", "_tag", F.transform(F.filter("lows", lambda x: x["low"] < F.col("doc_id")), lambda x: F.col("place") + x["place"]).alias("places")
    )
    return gathered.unionByName(late).groupBy("doc_id", "_tag").agg(F.flatten(F.collect_list("places")).alias("places"))


def _common(name: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each window: do more than ``HOT_ROWS`` rows have it?"""
    order = np.lexsort((row, name))
    starts = np.append(True, name[order][1:] != name[order][:-1])
    new_row = starts | np.append(True, row[order][1:] != row[order][:-1])
    group = np.cumsum(starts) - 1
    out = np.empty(len(name), bool)
    out[order] = (np.bincount(group[new_row]) > HOT_ROWS)[group]
    return out


def _runs(name: np.ndarray, row: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows: where they begin, each window's place in its run, the name of each run."""
    ends = mix(name.copy()) % _U(RUN) == 0
    begin = np.append(True, (row[1:] != row[:-1]) | (inside[1:] != inside[:-1] + 1) | ends[:-1])
    begins = np.flatnonzero(begin)
    sizes = np.diff(np.append(begins, len(name)))
    offset = (np.arange(len(name)) - np.repeat(begins, sizes)).astype(np.int32)
    return begins, offset, join(np.add.reduceat(join(name, offset.astype(np.uint64)), begins), sizes.astype(np.uint64))


def _packed(sent: Iterator[tuple[int, list[bytes]]], kind: int) -> pa.RecordBatch:
    sent = list(sent)
    columns = {c: [x[k] if k < len(x) else b"" for _, x in sent] for k, c in enumerate(_BLOBS)}
    return pa.RecordBatch.from_pydict({"cell": [k for k, _ in sent], **columns, "kind": [kind] * len(sent)}, schema=_WINDOWS)


def _found(kind: int, **columns) -> pa.RecordBatch:
    n = max(len(x) for x in columns.values())
    return pa.RecordBatch.from_pydict({"kind": [kind] * n} | {c: columns.get(c, [None] * n) for c in _FOUND.names[1:]}, schema=_FOUND)


def _search(buckets: int):
    def kernel(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        """Which entries of a bucket have a smaller doc_id beside them, and for common windows the smallest of all."""
        kinds = cell.column("kind").to_numpy()

        def read(*wanted: int) -> tuple[np.ndarray, ...]:
            own = cell.filter(pa.array(np.isin(kinds, wanted)))
            return tuple(_from_planes(own.column(c).to_pylist(), k) for c, k in zip(_BLOBS, (np.uint64, np.int64, np.int16, np.int32)))

        run, doc, tag, place = read(_RUN)
        if len(run):
            yield _found(_RUN, run=run.view(np.int64), doc_id=doc, _tag=tag.astype(np.int32), place=place)
        name, run, _, place = read(_PART)
        if len(name):  # other slices sent the same runs
            order, begins = groups(join(join(run.view(np.uint64), name), place.astype(np.uint64)))
            run, name, place = (c[order[begins[:-1]]] for c in (run, name, place))
            yield _found(_PART, run=run, name=name.view(np.int64), place=place)
        own, others = read(_OWN), read(_LOW)
        n, (name, doc) = len(own[0]), (np.concatenate([a, b]) for a, b in zip(own[:2], others[:2]))
        if not len(name):
            return
        tag, place = own[2:]
        order, begins = groups(name)
        low = np.repeat(np.minimum.reduceat(doc[order], begins[:-1]), np.diff(begins))
        hits = order[(doc[order] > low) & (order < n)]
        to = _bucket(doc[hits].view(np.uint64), buckets)
        sent = list(_by_bucket(to, doc[hits], tag[hits], place[hits]))
        if sent:
            yield _found(_MARK, cell=[k for k, _ in sent], docs=[x[0] for _, x in sent], tags=[x[1] for _, x in sent], places=[x[2] for _, x in sent])
        asked = order >= n
        if asked.any():
            names, at = np.unique(name[order][asked], return_index=True)
            yield _found(_LOW, name=names.view(np.int64), doc_id=low[asked][at])

    return kernel


def _gather(cell: pa.Table) -> Iterator[pa.RecordBatch]:
    """The marked places of each row of a bucket of documents."""
    doc, tag, place = (_from_planes(cell.column(c).to_pylist(), k) for c, k in zip(_BLOBS[1:], (np.int64, np.int16, np.int32)))
    order, edges = groups(join(doc.view(np.uint64), tag.astype(np.uint64)))
    first = order[edges[:-1]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc[first]), pa.array(tag[first].astype(np.int32)), pa.array([place[order[a:b]] for a, b in zip(edges[:-1], edges[1:])], pa.list_(pa.int32()))],
        ["doc_id", "_tag", "places"],
    )


RESULTS = "n_words long, n_removed long, kept_sha256 string"


def remove_repeats(documents: DataFrame, with_text: bool = True) -> DataFrame:
    """The documents with n_words, n_removed, kept_sha256 and, if asked for, text without the marked words.

    White space before a kept word stays as it was; a text that loses nothing is left untouched.
    """
    new = [x.split()[0] for x in RESULTS.split(", ")]
    columns = [c for c in documents.columns if c not in new and (with_text or c != "text")]
    marked = repeated_windows(documents).withColumnsRenamed({"doc_id": "_id", "_tag": "_of"})
    base = _tagged(documents.select(*dict.fromkeys([*columns, "doc_id", "text"])))
    same = (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_tag") == F.col("_of"))
    rows = base.join(marked, same, "left").drop("_tag", "_id", "_of")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column("text"))
                gone = np.zeros(len(words.start) + 1, np.int32)
                places = part.column("places")
                hit_rows = np.repeat(np.arange(part.num_rows), places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                at = words.first[hit_rows] + places.flatten().to_numpy(zero_copy_only=False)
                np.add.at(gone, at, 1)
                np.add.at(gone, at + WINDOW, -1)
                gone = np.cumsum(gone[:-1]) > 0
                lost = np.bincount(words.rows[gone], minlength=part.num_rows)
                digests, texts = [], part.column("text").to_pylist() if with_text else None
                for r in range(part.num_rows):
                    a, b = words.first[r], words.first[r + 1]
                    own = words.data[words.bounds[r] : words.bounds[r + 1]].tobytes()
                    if lost[r]:
                        start, end, keep = words.start[a:b] - words.bounds[r], words.end[a:b] - words.bounds[r], ~gone[a:b]
                        if with_text:
                            # From the end of the word before to the end of the word itself.
                            before = np.concatenate([[0], end[:-1]])
                            texts[r] = b"".join(own[x:y] for x, y in zip(before[keep], end[keep])).decode()
                        own = b" ".join(own[x:y] for x, y in zip(start[keep], end[keep]))
                        digests.append(hashlib.sha256(own).hexdigest())
                    else:
                        digests.append(hashlib.sha256(b" ".join(own.split())).hexdigest())
                arrays = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in columns]
                arrays += [pa.array(np.diff(words.first)), pa.array(lost.astype(np.int64)), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, *new])

    types = {f.name: f.dataType.simpleString() for f in base.schema}
    return rows.mapInArrow(run, ", ".join([f"`{c}` {types[c]}" for c in columns] + [RESULTS]))
