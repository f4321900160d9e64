"""Token ids of whole texts with a public tokenizer, a word at a time through a bounded cache.

Both kinds of vocabulary cut a text at single blanks between other characters, so ids of a text are
the ids of its blank-separated pieces one after another. A task encodes each new piece once, with
the tokenizers library, and looks it up from then on. Texts in which a blank touches other white
space are encoded whole where that matters.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import islice, repeat

import numpy as np

#: Pieces that a task remembers; later ones are encoded each time they come. A dict of up to 2/3 of 2^20 keys takes half the memory of a larger one.
CACHE_PIECES = 699_000
#: Pieces that are encoded in one call.
_TOGETHER = 1_000
#: White space other than blanks and line feeds.
_RARE = re.compile(r"[^\S \n]")
_MARK = "\x01"


def uneven(text: str) -> bool:
    """May a blank touch other white space, or begin or end the text?"""
    return text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text or _RARE.search(text) is not None


#: White space to Python, not to the library.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")


class Store:
    """Ids of numbered pieces, one after another in a growing array, of so many kinds."""

    def __init__(self, kinds: int) -> None:
        self.ids, self.start, self.size = np.zeros(1 << 16, np.min_scalar_type(kinds - 1)), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.n, self.used = 0, 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        total, n = len(ids), len(sizes)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) // 2, self.ids.dtype)])
        while self.n + n > len(self.start):
            self.start, self.size = (np.concatenate([a, np.zeros(len(a) // 2, a.dtype)]) for a in (self.start, self.size))
        self.ids[self.used : self.used + total] = ids
        self.size[self.n : self.n + n] = sizes
        self.start[self.n : self.n + n] = self.used + np.cumsum(sizes) - sizes
        self.n, self.used = self.n + n, self.used + total

    def cut(self, n: int) -> None:
        """Forget all pieces from number n on."""
        if n < self.n:
            self.used, self.n = int(self.start[n]), n

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces one after another, and how many each has."""
        sizes = self.size[codes].astype(np.int64)
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[codes] - ends + sizes, sizes)
        at += np.arange(len(at))
        return self.ids[at].astype(np.uint32), sizes


class Encoder:
    """Encodes lists of texts; one for each vocabulary lives as long as the Python worker."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        #: One kind marks a blank before a word by this character, the other the end of a word by </w>.
        self.blanks = not any(k.endswith("</w>") for k in vocabulary)
        self.begins = np.zeros(self.size, bool)
        self.ends_sentence = np.zeros(self.size, bool)
        for word, i in vocabulary.items():
            self.begins[i] = self.blanks and word.startswith("Ġ")
            bare = word.removesuffix("</w>").rstrip("\"')")
            self.ends_sentence[i] = bare.endswith((".", "!", "?")) or "Ċ" in word
        self.codes: dict[str, int] = {}
        self.store = Store(self.size)
        self.mark = self._ids(_MARK)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and how many each has: encoded together and cut where the next one begins.

        A vocabulary of the one kind takes each piece with the blank before it.
        """
        if self.blanks:
            ids = self._ids(" " + " ".join(pieces))
            at = np.flatnonzero(self.begins[ids])
            if len(at) == len(pieces) and at[0] == 0:
                return ids, np.diff(at, append=len(ids))
        elif len(self.mark) == 1:
            ids = self._ids(f" {_MARK} ".join(pieces))
            at = np.flatnonzero(ids == self.mark[0])
            if len(at) == len(pieces) - 1:
                return np.delete(ids, at), np.diff(at, prepend=-1, append=len(ids)) - 1
        apart = [self._ids(" " + x if self.blanks else x) for x in pieces]
        return np.concatenate(apart), np.array([len(x) for x in apart], np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        pieces: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        whole: dict[int, np.ndarray] = {}
        for i, text in enumerate(texts):
            if not text:
                continue
            # A blank before the first word is part of that word's piece.
            led = self.blanks and len(text) > 1 and text[0] == " "
            if uneven(text[1:] if led else text) if self.blanks else _SEPARATORS.search(text):
                whole[i] = self._ids(text)
                continue
            if not self.blanks:
                own = text.split()  # white space never lies inside an id of this kind
            else:
                head, *own = text.split(" ")
                if not led:
                    whole[i] = head
            pieces += own
            counts[i] = len(own)
        codes = np.fromiter(map(self.codes.get, pieces, repeat(-1)), np.int64, len(pieces))
        kept = self.store.n
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new = list(dict.fromkeys([pieces[k] for k in missing.tolist()]))
            for k in range(0, len(new), _TOGETHER):
                self.store.add(*self._apart(new[k : k + _TOGETHER]))
            numbers = dict(zip(new, range(kept, kept + len(new))))
            codes[missing] = [numbers[pieces[k]] for k in missing.tolist()]
            room = min(max(0, CACHE_PIECES - kept), len(new))
            self.codes.update(islice(numbers.items(), room))
            kept += room
        ids, sizes = self.store.take(codes)
        self.store.cut(kept)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        if not whole:
            return ids, np.diff(ends)
        # First words have no blank before them; they and texts encoded whole go between the rest.
        out, lengths = [], np.zeros(len(texts), np.int64)
        heads = [x for x in whole.values() if isinstance(x, str)]
        named = self._heads(heads)
        for i in range(len(texts)):
            head = whole.get(i, ids[:0])
            if isinstance(head, str):
                head = named[head]
            rest = ids[ends[i] : ends[i + 1]]
            out += [head, rest]
            lengths[i] = len(head) + len(rest)
        return np.concatenate(out) if out else ids[:0], lengths

    def _heads(self, heads: list[str]) -> dict[str, np.ndarray]:
        new = list(dict.fromkeys(heads))
        got = self.library.encode_batch_fast(new, add_special_tokens=False)
        return {x: np.array(y.ids, np.uint32) for x, y in zip(new, got)}


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's own encoder of a vocabulary file, which every machine has at this path."""
    return Encoder(path)


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The same with an id after each text."""
    if end is None:
        return ids, lengths
    return np.insert(ids, np.cumsum(lengths), end), lengths + 1
