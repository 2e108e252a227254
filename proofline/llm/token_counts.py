"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

Texts are cut after every word, where no pre-token crosses; chunks that a worker has not met before are
cut into pre-tokens by the tokenizer's pattern, and these are merged all at once: their bytes stand one after another in one array, every round looks up the rank of every
adjacent pair, finds each pre-token's lowest rank and merges all its pairs of that rank, from the left.
A merged pair can only enter pairs of higher ranks, so the order within one rank does not matter.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx
from proofline.llm.chunks import ASCII_SPACE, ChunkMemory, wide_space

# fixed value: the pattern that splits text before the merges of the vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 1_000_000
_NONE = np.int64(1) << 40


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in vocabulary files: printable bytes as they are, others from 256 up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankMerger:
    """Counts of merged symbols for pre-tokens given as bytes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.special = sorted((t["content"] for t in content.get("added_tokens", [])), key=len, reverse=True)
        vocabulary, letters = model["vocab"], _byte_letters()
        self.first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first[byte] = vocabulary[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]

    def _find(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], _NONE), at

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(len, pieces), np.int64, len(pieces))
        live = np.flatnonzero(out > 1)
        if not len(live):
            return out
        symbols = self.first[np.frombuffer(b"".join([pieces[i] for i in live]), np.uint8)]
        owner = np.repeat(live, out[live])
        while len(symbols) > 1:
            rank, at = self._find(symbols)
            rank = np.where(owner[:-1] == owner[1:], rank, _NONE)
            rank = np.append(rank, _NONE)
            begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(owner)))
            done = lowest == _NONE
            merge = (rank == np.repeat(lowest, sizes)) & (rank != _NONE)
            # of pairs that overlap only every second one merges, from the left
            place = np.flatnonzero(merge)
            run = np.concatenate([[True], np.diff(place) != 1])
            start = np.maximum.accumulate(np.where(run, np.arange(len(place)), 0))
            place = place[(np.arange(len(place)) - start) % 2 == 0]
            symbols[place] = self.made[at[place]]
            stay = np.ones(len(symbols), bool)
            stay[place + 1] = False
            out[owner[begins[done]]] = sizes[done]
            stay &= ~np.repeat(done, sizes)
            left = np.add.reduceat(stay.astype(np.int64), begins)
            single = left == 1
            out[owner[begins[single]]] = 1
            stay &= ~np.repeat(single, sizes)
            symbols, owner = symbols[stay], owner[stay]
        return out


class Counter:
    """Token counts of texts; remembers the counts of chunks, about REMEMBERED of them."""

    def __init__(self, path: str, pattern: str = PATTERN) -> None:
        self.merger, self.pattern = RankMerger(path), regex.compile(pattern)
        self.special = [s.encode() for s in self.merger.special]
        self.cut = re.compile(b"(?:" + b"|".join(map(re.escape, self.special)) + b")") if self.special else None
        self.memory = ChunkMemory(self._learn, np.int64, ASCII_SPACE, REMEMBERED)

    def _sizes(self, texts: list[str]) -> np.ndarray:
        """Token counts of texts given to the pattern as one string, in which no match crosses from one to the next."""
        pieces = self.pattern.findall("".join(texts))
        order = list(dict.fromkeys(pieces))
        size = dict(zip(order, self.merger.counts([p.encode() for p in order]).tolist(), strict=True))
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        totals = np.concatenate([[0], np.cumsum(np.fromiter(map(size.__getitem__, pieces), np.int64, len(pieces)))])
        return np.diff(totals[np.searchsorted(ends, np.concatenate([[0], np.cumsum(list(map(len, texts)))]), "right")])

    def _learn(self, keys: list[bytes], whole: bool) -> tuple[np.ndarray, np.ndarray]:
        texts = [k.decode() for k in keys]
        out = self._sizes(texts) if whole else np.array([self._sizes([t])[0] for t in texts])
        return out, np.ones(len(keys), np.int64)

    def count(self, texts: list[bytes]) -> list[int]:
        """The number of tokens of each text; a special string counts as one and cuts the text."""
        parts, owner, total = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
            total[i] = len(own) - 1
            for part in own:
                if wide_space(part):
                    total[i] += self._sizes([part.decode()])[0]
                else:
                    parts.append(part)
                    owner.append(i)
        values, n = self.memory.lookup(parts)
        np.add.at(total, np.repeat(np.array(owner, np.int64), n), values)
        return total.tolist()


_KEPT: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter of this vocabulary."""
    if path not in _KEPT:
        _KEPT[path] = Counter(path)
    return _KEPT[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of docs (doc_id, text).

    path: a byte-level BPE vocabulary file on every node. No special tokens are added; their strings in
    a text count as one token each. A null text counts as empty, 0 bytes and 0 tokens. Rows with a null
    doc_id and repeated rows stay. Other columns are ignored. A worker remembers REMEMBERED chunks.
    """

    def run(batches):
        count = counter(path).count
        for batch in batches:
            ids, raw = batch.column("doc_id"), tx.as_bytes(batch.column("text"))
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            numbers: list[int] = []
            for a, z in tx.slices(batch):
                numbers += count(raw[a:z])
            n = np.array(numbers, np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
