"""Cutting texts where byte-level BPE can never merge, so that equal chunks are encoded once.

The byte-level split pattern never joins a space with what stands before it when a
non-space follows: ``a bc`` always splits before `` bc``. A text is therefore the
concatenation of its chunks (cut before each space that a non-space follows), and its
ids are the concatenation of its chunks' ids. Words repeat a lot, chunks as well.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable
from weakref import WeakSet

import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r" (?=\S)")
_NO_CUT = re.compile(r" (?!\S)")
_LETTERS = frozenset(string.ascii_letters + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])))
_SIGNS = string.punctuation.replace("'", "")


def cut(text: str) -> list[str]:
    """Chunks of a text; their concatenation is the text."""
    if "\0" in text or _NO_CUT.search(text):
        first, *rest = _CUT.split(text)
        chunks = [first, *[" " + x for x in rest]]
    else:  # every space is a cut
        chunks = text.replace(" ", "\0 ").split("\0")
    return chunks if chunks[0] else chunks[1:]


def cut_all(texts: list[str]) -> pa.ListArray:
    """``cut`` of every text as one Arrow array (a text that begins with a cut has an empty first chunk)."""
    if any("\0" in t for t in texts):  # the mark stands in a text
        return pa.array([cut(t) for t in texts], pa.list_(pa.large_string()))
    marked = ["\0".join(cut(t)) if _NO_CUT.search(t) else t.replace(" ", "\0 ") for t in texts]
    return pc.split_pattern(pa.array(marked, pa.large_string()), "\0")


def may_split(chunk: str) -> bool:
    """False where ``parts`` would return the chunk as it is."""
    return "\n" in chunk or chunk[-1:] not in _LETTERS


def parts(chunk: str) -> list[str]:
    """Pieces of a chunk whose ids are the chunk's ids: the pattern splits around a newline
    between two non-spaces, and between a letter and signs (but for the apostrophe)."""
    head, newline, tail = chunk.partition("\n")
    if not newline:
        return _word_and_signs(chunk)
    if head and tail and not head[-1].isspace() and not tail[0].isspace():
        return [*_word_and_signs(head), newline, *_word_and_signs(tail)]
    return [chunk]


def _word_and_signs(piece: str) -> list[str]:
    word = piece.rstrip(_SIGNS)
    return [word, piece[len(word) :]] if len(word) < len(piece) and word and word[-1] in _LETTERS else [piece]


#: Every cache of this worker process.
_CACHES: WeakSet[ChunkCache] = WeakSet()


def release_caches() -> None:
    """Empty the caches that earlier tasks left in this worker: Spark reuses its processes, and
    what one operator has cached would count against the memory of the next one."""
    for cache in list(_CACHES):
        cache.clear()
    pa.default_memory_pool().release_unused()


class ChunkCache:
    """chunk -> what ``encode`` makes of it, for at most ``limit`` chunks and ``limit_chars`` characters.

    Misses of a whole batch are encoded together. Beyond the limit the cache starts
    afresh, so a worker's memory stays bounded whatever the texts are.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable], limit: int = 600_000, limit_chars: int = 16_000_000):
        self.encode, self.limit, self.limit_chars = encode, limit, limit_chars
        self.clear()
        _CACHES.add(self)

    def clear(self) -> None:
        self.known: dict[str, object] = {}
        self.chars = 0

    def learn(self, docs: list[list[str]]) -> dict[str, object]:
        """Make every chunk of ``docs`` known and return the mapping."""
        if len(self.known) > self.limit or self.chars > self.limit_chars:
            self.clear()
        missing = list({c for d in docs for c in d}.difference(self.known))
        self.known.update(zip(missing, self.encode(missing)))
        self.chars += sum(map(len, missing))
        return self.known


class AgedChunkCache(ChunkCache):
    """A cache of two generations of at most ``limit`` chunks and ``limit_chars`` characters each: a
    full one becomes the old one, and what is asked for again moves back, so frequent chunks stay known."""

    def clear(self) -> None:
        super().clear()
        self.old: dict[str, object] = {}

    def _age(self) -> None:
        if len(self.known) > self.limit or self.chars > self.limit_chars:
            self.old, self.known, self.chars = self.known, {}, 0

    def learn(self, docs: list[list[str]]) -> dict[str, object]:
        """Make every chunk of ``docs`` known and return the mapping."""
        self._age()
        unmet = set().union(*docs).difference(self.known)
        again = [c for c in unmet if c in self.old]
        missing = list(unmet.difference(again))
        self.known.update(zip(again, map(self.old.__getitem__, again)))
        self.known.update(zip(missing, self.encode(missing)))
        self.chars += sum(map(len, unmet))
        return self.known

    def values(self, chunks: list[str]) -> list:
        """What ``encode`` makes of each of some distinct chunks, in their order; a known one is looked up once."""
        self._age()
        known, old = self.known, self.old
        out = list(map(known.get, chunks))
        missing = []
        for i in [i for i, v in enumerate(out) if v is None]:
            c = chunks[i]
            self.chars += len(c)
            if (v := old.get(c)) is None:
                missing.append(i)
            else:
                out[i] = known[c] = v
        new = [chunks[i] for i in missing]
        for i, c, v in zip(missing, new, self.encode(new)):
            out[i] = known[c] = v
        return out


def groups_by_size(texts: list[str], limit: int = 4_000_000) -> Iterable[list[int]]:
    """Consecutive row numbers whose texts hold about ``limit`` characters (one long text stands alone)."""
    rows: list[int] = []
    total = 0
    for i, t in enumerate(texts):
        if rows and total + len(t) > limit:
            yield rows
            rows, total = [], 0
        rows.append(i)
        total += len(t)
    if rows:
        yield rows
