"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Vectors are of words (runs of letters, digits and bytes above 127, ASCII capitals made small). At most ``SAMPLE_ROWS`` labelled
documents, clean ones too, are the examples, each with all its words; document frequencies are
counted over all documents. A text's words that no example has count in its norm, with the document
frequency of their hashed bucket; they are in no product, so the order of examples is exact.

The index keeps, for each feature and block of examples, the largest weight in the block. A query adds
these up to a bound for each block and opens the blocks whose bound can reach the worst of its
``NEIGHBOURS`` best: the result is that of comparing with every example. Texts of a slice are searched together. Their votes, weighted by cosine and drawn to the base rate, are pooled (as odds) with
those of a second index over the telling features only (words and first 4, 5 and 6 bytes, in toxic examples too often for chance, by a bound
on the share of false ones) and mapped to probabilities by an isotonic fit on the examples, each without itself.

Defined results: null and empty texts, and texts without words, get the rate of examples without telling
features. Labels that are null are left out; several for one document count as
the largest. Repeated rows are scored alike; a null doc_id is never held out and never an example.
Extra columns are ignored. Without labels of both kinds every score is the base rate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkgate.llm.tiles import compare
from chunkgate.llm.words import Words, groups, hash_words, mix, sampled_texts, slices, split_words
from chunkgate.sources.tables import stored

#: Labelled documents that examples, vocabulary and calibration come from, at most: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
#: Telling features, at most.
VOCABULARY = 4096
#: Hashed buckets in which document frequencies of features that no example has are counted.
REST_BUCKETS = 1 << 21
PREFIXES = (4, 5, 6)
#: A feature must be in so many toxic examples; of those chosen, so small a share may be there by chance.
LEAST, FALSE_SHARE = 3, 0.05
NEIGHBOURS = 15
BLOCK = 64
#: Blocks that are multiplied together, and examples of which the highest counts when the best are looked for.
WAVE, FINE = 4, 16
#: Features, those of the most examples, that an opened index holds as matrices; the others are postings. No result depends on it.
HEAD = 1024
#: They are in at least one of so many examples.
DENSE = 12
#: Texts that are compared together.
TOGETHER = 128
#: Postings in a piece of an index, on average.
PIECE = 1 << 20
#: Cosines nearer than this are rounding.
SLACK = 1e-9
#: Pseudo-votes for the rate of texts without features.
PRIOR_VOTES = 0.25
HELD_OUT = 2
PREDICT_FROM = 0.3

_U = np.uint64
_SEPARATES = np.ones(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _SEPARATES[_a:_b] = False
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32


def held_out(doc_id: Column) -> Column:
    """Is the row kept from learning?"""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == HELD_OUT, F.lit(False))


def beginnings(words: Words, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Name and word of the beginnings of longer words. ``small``: the bytes of the texts with capitals made small."""
    padded = np.concatenate([small, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(small) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    names, at = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for size in PREFIXES:
        longer = np.flatnonzero(words.end - words.start > size)
        names.append(mix((eight[words.start[longer]] & _U((1 << 8 * size) - 1)) * _U(8) + _U(size)))
        at.append(longer)
    return np.concatenate(names), np.concatenate(at)


def counted(row: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, and how often each is there."""
    order = np.argsort(name)
    order = order[np.argsort(row[order].astype(np.uint16) if len(row) and row.max() < 1 << 16 else row[order], kind="stable")]  # short numbers are sorted by their digits
    row, name = row[order], name[order]
    begins = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (name[1:] != name[:-1]))) if len(row) else np.zeros(0, np.int64)
    return row[begins], name[begins], np.diff(np.append(begins, len(row)))


def row_features(texts: pa.Array) -> tuple[tuple, tuple]:
    """Row and name of all words and of all their beginnings."""
    words = split_words(texts, _SEPARATES)
    small = _SMALL[words.data]
    row = words.rows
    name, at = beginnings(words, small)
    return (row, hash_words(words, small)), (row[at], name)


def among(names: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a name is one of ``names``, few names in order, and the number of each of those. Most others differ in their last 16 bits from all."""
    last = np.zeros(1 << 16, bool)
    last[names & _U(0xFFFF)] = True
    at = np.flatnonzero(last[name & _U(0xFFFF)])
    number, there = places(names, name[at])
    return at[there], number[there]


def places(names: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each name among ``names``, which are in order, and whether it is there."""
    number = np.searchsorted(names, name)
    return number, names[np.minimum(number, len(names) - 1)] == name if len(names) else np.zeros(len(name), bool)


@dataclass
class Vocabulary:
    """Words of the examples and telling features by name, in order, each with its idf; idf of each bucket of other words."""

    names: np.ndarray
    idf: np.ndarray
    rest_idf: np.ndarray
    telling: np.ndarray
    telling_idf: np.ndarray

    def numbered(self, texts: pa.Array) -> tuple[tuple, tuple, tuple]:
        """Row, number and count of the words that examples have, of other words by their buckets, and of telling features."""
        (row, name), (more_row, more) = row_features(texts)
        row, name, count = counted(row, name)
        number, known = places(self.names, name)
        other = ~known
        rest = row[other], (name[other] % _U(REST_BUCKETS)).astype(np.int64), count[other]
        telling, word = among(self.telling, name)
        too, begun = among(self.telling, more)
        more_row, begun, more_count = counted(more_row[too], begun)
        told = [np.concatenate([x, y]) for x, y in ((row[telling], more_row), (word, begun), (count[telling], more_count))]
        order = np.argsort(told[0], kind="stable")
        return (row[known], number[known], count[known]), rest, tuple(x[order] for x in told)

    def vectors(self, texts: pa.Array) -> list[tuple]:
        """For each text: numbers and counts of words that examples have, the square of the other words' weights, numbers and counts of telling features."""
        words, (row, bucket, count), told = self.numbered(texts)
        rest = np.bincount(row, ((1 + np.log(count)) * self.rest_idf[bucket]) ** 2, len(texts)).tolist()
        (a, b), (c, d) = ([np.split(x, np.searchsorted(r, np.arange(1, len(texts)))) for x in y] for r, *y in (words, told))
        return list(zip(a, b, rest, c, d))


def _spread(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each begin up to its end, one range after another."""
    sizes = end - begin
    return np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Index:
    """Examples by feature, in blocks with their largest weights.

    ``pieces`` hold the postings by feature and example: for each range of features the number of
    postings of each, their examples and their counts, as bytes. Only these travel; ``opened`` makes
    the arrays of a search from them, once in each worker.
    """

    def __init__(self, idf: np.ndarray, rows: list[tuple] = (), k: int = NEIGHBOURS, made: tuple | None = None) -> None:
        self.idf, self.k = idf, k
        if made is None:
            vectors = sorted(((strongest(self.weights(number, count), number), doc, label, number, count) for doc, label, number, count, *_ in rows), key=lambda x: x[:3])
            number, count = (np.concatenate([x[c] for x in vectors] or [np.zeros(0, np.int64)]) for c in (3, 4))
            example = np.repeat(np.arange(len(vectors)), [len(x[3]) for x in vectors])
            made = [x[1] for x in vectors], [x[2] for x in vectors], [postings(number, example, count, 0, len(idf))]
        self.docs, self.labels, self.pieces = np.array(made[0], np.int64), np.array(made[1], np.float64), made[2]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("opened", "at")}

    def weights(self, number: np.ndarray, count: np.ndarray, rest: float = 0.0) -> np.ndarray:
        w = (1 + np.log(count)) * self.idf[number]
        return w / np.sqrt((w * w).sum() + rest)

    @cached_property
    def opened(self) -> Opened:
        return Opened(self)

    @cached_property
    def at(self) -> dict[int, int]:
        """The place of each example by its doc_id."""
        return {int(d): k for k, d in enumerate(self.docs)}

    def nearest(self, number: np.ndarray, count: np.ndarray, without: int = -1, rest: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """The examples nearest to a text and their cosines, the highest first (ties: the earlier example).

        ``rest``: the square of the weights of the text's features that are in no example.
        """
        return self.nearest_of([(number, count, rest)], [without])[0]

    def nearest_of(self, vectors: list[tuple], without: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` for many texts: number, count and rest of each, and the example that is left out (or -1)."""
        out = []
        for a in range(0, len(vectors), TOGETHER):
            part = vectors[a : a + TOGETHER]
            out += self.opened.nearest([x[0] for x in part], [self.weights(*x) for x in part], without[a : a + TOGETHER], self.k)
        return out


def strongest(weight: np.ndarray, number: np.ndarray) -> int:
    """The feature with the largest weight, -1 for no features. Neighbours by it stand together, so that few blocks have high bounds."""
    return int(number[weight.argmax()]) if len(number) else -1


def small(x: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold the largest."""
    return x.astype(np.min_scalar_type(int(x.max()))).tobytes() if len(x) else b""


def unpacked(data: bytes, n: int) -> np.ndarray:
    """``n`` numbers that ``small`` wrote."""
    return np.frombuffer(data, f"u{len(data) // n}") if n else np.zeros(0, np.uint8)


def postings(number: np.ndarray, example: np.ndarray, count: np.ndarray, first: int, last: int) -> tuple[int, bytes, bytes, bytes]:
    """A piece of an index: the features from ``first`` up to ``last``."""
    order = np.lexsort((example, number))
    return len(order), np.bincount(number - first, minlength=last - first).astype(np.int32).tobytes(), small(example[order]), small(count[order])


class Opened:
    """An index as arrays. Features of the most examples are held as a matrix for each ``WAVE`` blocks, the others as postings."""

    def __init__(self, index: Index) -> None:
        n = len(index.docs)
        size = np.concatenate([np.frombuffer(p[1], np.int32) for p in index.pieces]) if index.pieces else np.zeros(0, np.int32)
        example = np.concatenate([np.zeros(0, np.int32), *(unpacked(p[2], p[0]).astype(np.int32) for p in index.pieces)])
        weight = np.concatenate([np.zeros(0, np.float32), *((1 + np.log(unpacked(p[3], p[0]).astype(np.float64))).astype(np.float32) for p in index.pieces)])
        weight *= np.repeat(index.idf[: len(size)].astype(np.float32), size)
        weight /= np.sqrt(np.bincount(example, weight.astype(np.float64) ** 2, n)).astype(np.float32)[example]
        self.n_waves = -(-n // (BLOCK * WAVE))
        first = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        common = np.sort(np.argsort(-size, kind="stable")[:HEAD])
        common = common[size[common] * DENSE >= max(n, 1)]
        self.place = np.full(len(size), -1, np.int32)
        self.place[common] = np.arange(len(common))
        at = _spread(first[common], first[common + 1])
        wide = BLOCK * WAVE
        self.head = np.zeros((self.n_waves, len(common), wide), np.float32)
        self.head[example[at] // wide, np.repeat(np.arange(len(common)), size[common]), example[at] % wide] = weight[at]
        most = self.head.reshape(self.n_waves, len(common), WAVE, BLOCK).max(axis=3)
        self.most = np.ascontiguousarray(most.transpose(1, 0, 2).reshape(len(common), -1), np.float64)
        #: Sums in single precision are off by at most this share: no term is negative.
        self.off = (len(common) + 8) * 2.0**-23
        # The matrix holds the common features: their postings are not needed twice.
        rare = np.ones(len(example), bool)
        rare[at] = False
        self.first = np.concatenate([[0], np.cumsum(np.where(self.place < 0, size, 0), dtype=np.int64)])
        self.example = example[rare]
        #: Of each posting the example, and in the lower half the weight's bits: both come with one look.
        self.rare = self.example.astype("<i8") << 32 | weight[rare].astype("<f4").view("<u4")
        self.counting = np.arange(1 << 17)

    def _rare(self, begin: np.ndarray, end: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Products of a text with all examples over its rare features, whose postings these are."""
        sizes = end - begin
        ends = np.cumsum(sizes)
        at = np.repeat(begin - ends + sizes, sizes)
        at += self.counting[: len(at)] if len(at) <= len(self.counting) else np.arange(len(at))
        found = self.rare[at]
        product = np.repeat(q, sizes)
        product *= found.view(np.float32)[::2]
        found >>= 32
        return np.bincount(found, product, self.n_waves * WAVE * BLOCK)

    def nearest(self, numbers: list[np.ndarray], weights: list[np.ndarray], without: list[int], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Products over rare features come from their postings, and with the block maxima of the common ones bound each
        block. Blocks are opened for the texts whose k-th best they can reach: products over common features in single
        precision, and those of the examples that can be among the k best again in double."""
        m = len(numbers)
        if not self.n_waves:
            return [(np.zeros(0, np.int64), np.zeros(0))] * m
        text, number, q = np.repeat(np.arange(m), [len(x) for x in numbers]), np.concatenate(numbers), np.concatenate(weights)
        place = self.place[number]
        held = place >= 0
        asked = np.zeros((m, self.most.shape[0]))
        asked[text[held], place[held]] = q[held]
        places = np.split(place[held], np.searchsorted(text[held], np.arange(1, m)))
        text, number, q = text[~held], number[~held], q[~held]
        begin, end = self.first[number], self.first[number + 1]
        ends = np.searchsorted(text, np.arange(m + 1)).tolist()
        n_blocks = self.n_waves * WAVE
        score = np.empty((m, n_blocks * BLOCK))
        for r, (x, y) in enumerate(zip(ends[:-1], ends[1:])):  # one text at a time: its sums stay in the cache
            score[r] = self._rare(begin[x:y], end[x:y], q[x:y])
        top = score.reshape(m, n_blocks, BLOCK).max(axis=2)
        bound = top + asked @ self.most
        out = np.array(without)
        left_out = np.flatnonzero(out >= 0)
        score[left_out, out[left_out]] = -np.inf
        top[left_out, out[left_out] // BLOCK] = score.reshape(m, n_blocks, BLOCK)[left_out, out[left_out] // BLOCK].max(axis=1)

        single = asked.astype(np.float32)
        total = np.full((m, n_blocks * BLOCK), -np.inf, np.float32)
        order = np.argsort(-bound.reshape(m, self.n_waves, WAVE).max(axis=2).sum(axis=0), kind="stable")
        for done, wave in enumerate(order.tolist()):
            if done & (done - 1) == 0:  # the k-th best is at least the k-th highest of the blocks: looked up anew after 1, 2, 4, 8, ... waves
                least = _highest(top, k) * (1 - 2 * self.off) - SLACK
            blocks, examples = slice(wave * WAVE, (wave + 1) * WAVE), slice(wave * WAVE * BLOCK, (wave + 1) * WAVE * BLOCK)
            rows = np.flatnonzero(((bound[:, blocks] >= least[:, None]) & (bound[:, blocks] > 0)).any(axis=1))
            if len(rows):
                if 8 * len(rows) > 7 * m:
                    rows = slice(None)  # few are left: parts of arrays cost less than chosen rows
                found = single[rows] @ self.head[wave]
                found += score[rows, examples]
                total[rows, examples] = found
                top[rows, blocks] = found.reshape(-1, WAVE, BLOCK).max(axis=2)
        least = np.maximum(_highest(total.reshape(m, -1, FINE).max(axis=2), k), SLACK) * (1 - 4 * self.off)
        return [self._best(total[r], least[r], score[r], asked[r], places[r], k) for r in range(m)]

    def _best(self, total: np.ndarray, least: float, rare: np.ndarray, asked: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best examples of a text, whose sums in single precision and least one these are, with sums in double."""
        near = np.flatnonzero(total >= least)
        if len(near) > k:
            value = total[near]
            near = near[value >= np.partition(value, len(value) - k)[len(value) - k] * (1 - 4 * self.off)]
        wide = BLOCK * WAVE
        cosine = rare[near] + asked[places] @ self.head[near // wide, places[:, None], near % wide]
        if len(near) > k:
            least = np.partition(cosine, len(cosine) - k)[len(cosine) - k]
        else:
            least = 0.0
        # Equal cosines differ by rounding only; of them the earlier example comes first.
        good = cosine >= max(least - SLACK, SLACK)
        near, cosine = near[good], cosine[good]
        order = np.lexsort((near, -np.round(cosine, 9)))[:k]
        return near[order], cosine[order]


def _highest(x: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest of each row, 0 where there are fewer."""
    return np.maximum(np.partition(x, x.shape[1] - k, axis=1)[:, x.shape[1] - k], 0.0) if x.shape[1] >= k else np.zeros(len(x))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps of y over x, by pooling neighbours that fall: middle of each step, its rate drawn to 1/2 by half a case."""
    order = np.lexsort((y, x))
    pools: list[list[float]] = []
    for a, b in zip(x[order], y[order]):
        pools.append([b, 1.0, a, a])
        while len(pools) > 1 and (pools[-2][3] == pools[-1][2] or pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    return np.array([(p[2] + p[3]) / 2 for p in pools]), np.array([(p[0] + 0.25) / (p[1] + 0.5) for p in pools])


@dataclass
class Model:
    """Vocabulary and indexes are broadcast; their size is bounded by the sample."""

    words: Broadcast
    #: The index over words and that over telling features.
    indexes: Broadcast
    base: float
    empty_rate: float
    steps: np.ndarray
    rates: np.ndarray

    @property
    def vocabulary(self) -> Vocabulary:
        return self.words.value

    @property
    def index(self) -> Index:
        return self.indexes.value[0]

    def votes(self, vectors: list[tuple], own: list[int | None] | None = None) -> tuple[np.ndarray, list]:
        """The votes on texts, and the nearest examples of each with their cosines. ``own``: doc_ids, each left out of its own vote."""
        index, telling = self.indexes.value
        own = own or [None] * len(vectors)
        near = index.nearest_of([x[:3] for x in vectors], [index.at.get(i, -1) for i in own])
        whole = np.array([_share(index, *x, self.base) for x in near])
        rows = [r for r, x in enumerate(vectors) if len(x[3])]
        some = np.full(len(vectors), self.empty_rate)
        some[rows] = [_share(telling, *x, self.empty_rate) for x in telling.nearest_of([(*vectors[r][3:], 0.0) for r in rows], [telling.at.get(own[r], -1) for r in rows])]
        return _pooled(whole, some), near

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        return np.interp(votes, self.steps, self.rates) if len(self.steps) else votes


def _share(index: Index, best: np.ndarray, cosine: np.ndarray, rate: float) -> float:
    return float(((cosine * index.labels[best]).sum() + PRIOR_VOTES * rate) / (cosine.sum() + PRIOR_VOTES))


def _pooled(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The share whose odds are the product of both odds."""
    return p * q / (p * q + (1 - p) * (1 - q))


def _vocabulary_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = [counted(*x)[:2] for x in row_features(part.column("text"))]
            row, name = (np.concatenate([x[k] for x in found]) for k in (0, 1))
            is_word = np.arange(len(row)) < len(found[0][0])
            toxic = part.column("toxic").to_numpy().astype(np.int64)[row]
            order, begins = groups(name)
            first = order[begins[:-1]]
            total = np.concatenate([[0], np.cumsum(toxic[order])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[first].view(np.int64)), pa.array(is_word[first]), pa.array(np.diff(begins)), pa.array(total[begins[1:]] - total[begins[:-1]])],
                ["name", "is_word", "n", "n_toxic"],
            )


def _surprise(hits: Column, n: Column, base: float) -> Column:
    """n times the divergence of a share from the base rate: chance alone reaches it with probability below exp(-it)."""
    p = hits / n
    rest = F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(0.0)
    return n * (p * F.log(p / base) + rest)


def fit_toxicity(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Vocabulary, index and calibration from the labelled rows that may be learned from."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = stored(sampled_texts(documents, sample), "labelled")
    n, n_toxic = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = n_toxic / n if n else 0.0
    counts = texts.mapInArrow(_vocabulary_counts, "name long, is_word boolean, n long, n_toxic long").groupBy("name").agg(
        F.max("is_word").alias("is_word"), F.sum("n").alias("n"), F.sum("n_toxic").alias("t")
    )
    names = chosen_names = np.zeros(0, np.uint64)
    if 0 < n_toxic < n:
        counts = stored(counts, "features")
        names = np.sort(counts.where("is_word").select("name").toArrow()["name"].to_numpy().view(np.uint64))
        tried = counts.where(F.col("n") >= LEAST)
        above = tried.where((F.col("t") >= LEAST) & (F.col("t") > F.col("n") * base)).withColumn("surprise", _surprise(F.col("t"), F.col("n"), base))
        chosen = above.orderBy(F.desc("surprise"), "name").limit(VOCABULARY).toPandas()
        by_chance = tried.count() * np.exp(-chosen["surprise"].to_numpy())
        fine = np.flatnonzero(by_chance <= FALSE_SHARE * np.arange(1, len(chosen) + 1))
        chosen_names = np.sort(chosen["name"].to_numpy(np.int64)[: fine[-1] + 1 if len(fine) else 0].view(np.uint64))

    # Numbers of words, of buckets of other words, of telling features, and of the rows.
    ends = np.cumsum([len(names), REST_BUCKETS, len(chosen_names)])
    plain = Vocabulary(names, None, None, chosen_names, None)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(ends[2] + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                known, rest, told = plain.numbered(part.column("text"))
                number = np.concatenate([known[1], rest[1] + ends[0], told[1] + ends[1]])
                found += np.bincount(number, minlength=len(found))
                found[-1] += part.num_rows
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"number": some, "n": found[some]})

    df = np.zeros(ends[2] + 1, np.int64)
    if len(names):
        found = documents.select("text").mapInArrow(frequencies, "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).toArrow()
        df[found["number"].to_numpy()] = found["n"].to_numpy()
        del found
    idf, rest_idf, telling_idf = np.split((np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32), ends[:2])
    broadcast = documents.sparkSession.sparkContext.broadcast
    words = broadcast(Vocabulary(names, idf, rest_idf, chosen_names, telling_idf))
    index, _ = _built(texts, words, 0)
    telling, bare = _built(texts, words, 3)
    model = Model(words, broadcast((index, telling)), float(base), float((sum(bare) + base) / (len(bare) + 1)), np.zeros(0), np.zeros(0))
    if len(names):
        votes = texts.mapInArrow(_own_votes(model), "vote double, label double").toPandas()
        model.steps, model.rates = isotonic(votes["vote"].to_numpy(), votes["label"].to_numpy())
    return model


def _built(texts: DataFrame, words: Broadcast, at: int) -> tuple[Index, list[int]]:
    """The index of the examples, and the labels of those that have none of its features. ``at``: where a vector has them.

    Tasks make the vectors and sort the postings; the driver sees one short row for each example and the finished pieces.
    """
    idf = words.value.telling_idf if at else words.value.idf
    n_features = len(idf)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = Index(words.value.telling_idf if at else words.value.idf)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [x[at : at + 2] for x in words.value.vectors(part.column("text"))]
                own = [part.column("doc_id").cast(pa.int64()), part.column("toxic").cast(pa.int32())]
                tops = [strongest(empty.weights(a, c), a) for a, c in found]
                yield pa.RecordBatch.from_arrays(own + [pa.array(tops, pa.int64()), pa.array([len(a) for a, _ in found], pa.int64())], ["doc_id", "toxic", "strongest", "size"])

    rows = texts.mapInArrow(heads, "doc_id long, toxic int, strongest long, size long").toPandas()
    bare = rows.loc[rows["size"] == 0, "toxic"].tolist()
    rows = rows[rows["size"] > 0].sort_values(["strongest", "doc_id"])
    width = max(1, -(-n_features // max(1, -(-int(rows["size"].sum()) // PIECE))))
    by_id = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    ids = rows["doc_id"].to_numpy()[by_id]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [(doc, *x[at : at + 2]) for doc, x in zip(part.column("doc_id").to_pylist(), words.value.vectors(part.column("text"))) if len(x[at])]
                if not found:
                    continue
                number, count = (np.concatenate([x[k] for x in found]) for k in (1, 2))
                example = np.repeat(by_id[np.searchsorted(ids, [x[0] for x in found])], [len(x[1]) for x in found])
                order, begins = groups(number // width)
                out = [(int(number[o[0]] // width), len(o), *(small(x[o]) for x in (number % width, example, count))) for o in np.split(order, begins[1:-1])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["cell", "n", "number", "example", "count"])

    def merged(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        part, n = cell.column("cell")[0].as_py(), cell.column("n").to_pylist()
        arrays = [np.concatenate([unpacked(x, k).astype(np.int64) for x, k in zip(cell.column(c).to_pylist(), n)]) for c in ("number", "example", "count")]
        piece = postings(*arrays, 0, min(width, n_features - part * width))
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, *piece)], ["cell", "n", "size", "example", "count"])

    pieces = compare(texts.mapInArrow(dealt, "cell long, n long, number binary, example binary, count binary"), merged, "cell long, n long, size binary, example binary, count binary")
    got = {r["cell"]: (r["n"], *(bytes(r[c]) for c in ("size", "example", "count"))) for r in pieces.toLocalIterator()} if n_features else {}
    made = [got.get(k, (0, bytes(4 * (min(f + width, n_features) - f)), b"", b"")) for k, f in enumerate(range(0, n_features, width))]
    return Index(idf, made=(rows["doc_id"].to_numpy(), rows["toxic"].to_numpy(), made)), bare


def _own_votes(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                vectors = model.vocabulary.vectors(part.column("text"))
                some = [r for r, x in enumerate(vectors) if len(x[0])]
                ids, labels = part.column("doc_id").cast(pa.int64()).to_pylist(), part.column("toxic").to_pylist()
                votes, _ = model.votes([vectors[r] for r in some], [ids[r] for r in some])
                yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), pa.array([float(labels[r]) for r in some], pa.float64())], ["vote", "label"])

    return run


def score_toxicity(documents: DataFrame, model: Model, evidence: int = 3) -> DataFrame:
    """doc_id, held_out, score, predicted, and the nearest examples with their cosines: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score = np.full(part.num_rows, model.empty_rate)
                near: list = [[]] * part.num_rows
                cosines: list = [[]] * part.num_rows
                vectors = model.vocabulary.vectors(part.column("text")) if learned else []
                some = [r for r, x in enumerate(vectors) if len(x[0]) or x[2]]
                if some:
                    votes, found = model.votes([vectors[r] for r in some])
                    score[some] = model.calibrated(votes)
                    for r, (best, cosine) in zip(some, found):
                        near[r], cosines[r] = model.index.docs[best[:evidence]].tolist(), cosine[:evidence].tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(score), pa.array((score >= PREDICT_FROM).astype(np.int32)),
                        pa.array(near, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64())),
                    ],
                    ["doc_id", "score", "predicted", "evidence", "evidence_cosine"],
                )

    learned = len(model.vocabulary.names) > 0
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(run, "doc_id long, score double, predicted int, evidence array<long>, evidence_cosine array<double>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence", "evidence_cosine")
