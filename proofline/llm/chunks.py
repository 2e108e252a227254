"""Values of texts put together from the remembered values of their chunks.

A chunk is a run of separators with the word after it, or the separators at a text's end; a word can be cut
further, so that marks after it do not make it another chunk. All chunks of a batch are hashed at once; each different one is looked up once in the worker's memory, and those
that are new are learned in one call.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np

from proofline.llm import text as tx

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
BLANK = np.zeros(256, bool)
BLANK[32] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
MARK = np.zeros(256, bool)
MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
# the second bytes of U+00C0 to U+00FF without the two signs among them
LATIN = np.zeros(256, bool)
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False
# fixed values: white space outside ASCII, in UTF-8
WIDE_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def wide_space(text: bytes) -> bool:
    return not text.isascii() and any(s in text for s in WIDE_SPACE)


def mark_cuts(data: np.ndarray) -> np.ndarray:
    """Where an ASCII mark follows a Latin letter; no pre-token of the byte-level pattern goes from letters on to marks."""
    at = np.flatnonzero(MARK[data[1:]]) + 1
    latin = (data[np.maximum(at - 2, 0)] == 0xC3) & LATIN[data[at - 1]]
    return at[LETTER[data[at - 1]] | latin]


class ChunkMemory:
    """Remembers about `limit` chunks.

    learn(chunks, whole) gives the values of new chunks, one after another, and how many each has; whole
    says that they all begin with a separator and end with a word. cuts(bytes) gives more places where
    chunks end, inside words.
    """

    def __init__(
        self, learn: Callable[[list[bytes], bool], tuple[np.ndarray, np.ndarray]], kind, separator: np.ndarray, limit: int, cuts: Callable[[np.ndarray], np.ndarray] | None = None
    ) -> None:
        self.learn, self.kind, self.separator, self.limit, self.cuts = learn, kind, separator, limit, cuts
        self._empty()

    def _empty(self) -> None:
        self.index: dict[bytes, int] = {}
        self.values, self.used = np.zeros(1 << 16, self.kind), 0
        self.begin, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _room(self, name: str, size: int) -> None:
        old = getattr(self, name)
        if size > len(old):
            new = np.zeros(max(size, 2 * len(old)), old.dtype)
            new[: len(old)] = old
            setattr(self, name, new)

    def _add(self, keys: list[bytes]) -> np.ndarray:
        """Learns new chunks; the number of each of them."""
        firsts, lasts = (np.fromiter((k[i] for k in keys), np.uint8, len(keys)) for i in (0, -1))
        whole, at = self.separator[firsts] & ~self.separator[lasts], np.zeros(len(keys), np.int64)
        for flag in (True, False):
            some = np.flatnonzero(whole == flag)
            if len(some):
                at[some] = len(self.index) + np.arange(len(some))
                part = [keys[i] for i in some.tolist()]
                self._put(part, *self.learn(part, flag))
        return at

    def _put(self, keys: list[bytes], values: np.ndarray, counts: np.ndarray) -> None:
        n, total = len(self.index), self.used + len(values)
        self._room("values", total)
        self._room("begin", n + len(keys))
        self._room("count", n + len(keys))
        self.values[self.used : total] = values
        self.count[n : n + len(keys)] = counts
        self.begin[n : n + len(keys)] = self.used + np.cumsum(counts) - counts
        self.index.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.used = total

    def _split(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        joined = b" ".join([*texts, b""])
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.cumsum(lengths + 1) - lengths - 1
        data = np.frombuffer(joined, np.uint8)
        inside = ~self.separator[data]
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        stops = begins + lengths
        more = [] if self.cuts is None else [self.cuts(data)]
        cuts = np.sort(np.concatenate([ends, begins, stops, *more]), kind="stable")
        cuts = cuts[np.concatenate([[True], cuts[1:] != cuts[:-1]])] if len(cuts) else cuts
        a, z = cuts[:-1], cuts[1:]
        mine = np.ones(len(cuts), bool)
        mine[np.searchsorted(cuts, stops)] = False
        mine = mine[:-1]
        a, z = a[mine], z[mine]
        return joined, a, z, np.searchsorted(begins, a, "right") - 1

    def lookup(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The values of all texts in order, and how many each text has."""
        joined, a, z, owner = self._split(texts)
        if not len(a):
            return np.zeros(0, self.kind), np.zeros(len(texts), np.int64)
        hashes = tx.range_hashes(np.frombuffer(joined, np.uint8), a, z)
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        keys = [joined[x:y] for x, y in zip(a[first].tolist(), z[first].tolist(), strict=True)]
        at = np.fromiter(map(self.index.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(at < 0)
        if len(self.index) + len(new) > self.limit and self.index:
            self._empty()
            new = np.arange(len(keys))
        if len(new):
            at[new] = self._add([keys[i] for i in new.tolist()])
        at = at[inverse]
        n, begin = self.count[at], self.begin[at]
        place = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.values[place], np.bincount(owner, n, len(texts)).astype(np.int64)
