"""SentencePiece encoding by backtracking, and decoding.

Merge-type vocabularies always merge the adjacent pair whose joined piece has the best score. Its result
is the only way to cut a text into pieces in which every two neighbours are compatible: merging their
joined letters again gives the same two pieces. So the text is cut from the left with the longest pieces
an Aho-Corasick automaton finds; a piece that does not fit its neighbour gives way to a shorter one,
and a position from which no piece fits is marked in a bit field and never tried again. Letters without
a piece become their bytes. No piece crosses from a letter to a following space mark, so texts are cut
there and a worker remembers the ids of such chunks.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx
from proofline.llm.chunks import BLANK, ChunkMemory

MARK = "▁"
REMEMBERED = 800_000


class PieceEncoder:
    """Ids of texts for one merge-type vocabulary with bytes for unknown letters."""

    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        plain = [i for i in range(lib.vocab_size()) if not (lib.IsControl(i) or lib.IsUnknown(i) or lib.IsByte(i) or lib.IsUnused(i))]
        self.score = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        self.ids = {lib.id_to_piece(i): i for i in plain}
        self.text = {i: lib.id_to_piece(i) for i in plain}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        crossing = [p for p in self.ids if MARK in p.lstrip(MARK)]
        # a piece whose letters do not merge into it never occurs
        real = {piece: i for piece, i in self.ids.items() if self.merged(piece) == [piece]}
        self.size = {i: len(piece) for piece, i in real.items()}
        self.shorter = {i: next((real[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in real), -1) for piece, i in real.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in real.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.whole = bool(crossing)
        self.forget()

    def forget(self) -> None:
        """Start again without remembered chunks and pairs."""
        self.fits: dict[tuple[int, int], bool] = {}
        self.memory = ChunkMemory(self._learn, "<u4", BLANK, REMEMBERED)

    def merged(self, letters: str) -> list[str]:
        """The pieces that repeated best merges leave, the leftmost of equal scores first."""
        parts, score = list(letters), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        pair = (a, b)
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) > REMEMBERED:
                self.fits.clear()
            left, right = self.text[a], self.text[b]
            known = self.fits[pair] = self.merged(left + right) == [left, right]
        return known

    def cut(self, chunk: str) -> list[int]:
        """Ids of one chunk; -2 - position stands for a letter without a piece."""
        n = len(chunk)
        longest = list(range(-2, -2 - n, -1))
        for last, (size, i) in self.automaton.iter(chunk):
            longest[last - size + 1] = i  # ends come in ascending order, so the longest stays
        size, shorter, fits = self.size, self.shorter, self.fits
        failed = bytearray(n // 8 + 1)
        path: list[int] = []
        at, i, before = 0, longest[0], -2
        while at < n:
            while i != -1:
                to = at + size.get(i, 1)
                if not failed[to >> 3] >> (to & 7) & 1 and (before < 0 or i < 0 or (fits[before, i] if (before, i) in fits else self.compatible(before, i))):
                    break
                i = shorter.get(i, -1)
            if i != -1:
                path.append(i)
                at, before = to, i
                i = longest[at] if at < n else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if not path:
                    raise ValueError("no compatible cut")
                i = path.pop()
                at -= size.get(i, 1)
                before = path[-1] if path else -2
                i = shorter.get(i, -1)
        return path

    def _learn(self, keys: list[bytes], whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
        out, counts = [], np.zeros(len(keys), np.int64)
        for k, key in enumerate(keys):
            chunk = key.decode().replace(" ", MARK)
            path = self.cut(chunk)
            if min(path) < 0:
                path = [j for i in path for j in ([i] if i >= 0 else [self.bytes[b] for b in chunk[-2 - i].encode()])]
            out += path
            counts[k] = len(path)
        return np.array(out, "<u4"), counts

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """All ids of each text with begin and end, as little-endian unsigned 32-bit integers."""
        first, last = np.array([self.begin], "<u4").tobytes(), np.array([self.end], "<u4").tobytes()
        mark = MARK.encode()
        plain = [not self.whole and mark not in t for t in texts]
        values, n = self.memory.lookup([b" " + t if t else t for t, p in zip(texts, plain, strict=True) if p])
        parts = iter(np.split(values, np.cumsum(n)[:-1]) if len(n) else [])
        rest = [None if p else self._learn([b" " + t])[0] if t else np.zeros(0, "<u4") for t, p in zip(texts, plain, strict=True)]
        return [first + (next(parts) if p else r).tobytes() + last for p, r in zip(plain, rest, strict=True)]

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


_KEPT: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of this vocabulary."""
    if path not in _KEPT:
        _KEPT[path] = PieceEncoder(path)
    return _KEPT[path]


def encode_pieces(docs: DataFrame, path: str, with_output: bool = False, keep: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids, decoded) for every row of docs (doc_id, text).

    path: a merge-type SentencePiece model with byte pieces, on every node. ids (little-endian unsigned
    32-bit) and decoded text are filled if with_output. A null text counts as empty: begin and end only.
    Rows with a null doc_id and repeated rows stay. Other columns are ignored. A worker remembers about
    REMEMBERED chunks and as many pairs; with keep false, only as long as a task.
    """

    def run(batches):
        own = encoder(path)
        for batch in batches:
            ids, raw, rows = batch.column("doc_id"), tx.as_bytes(batch.column("text")), []
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
            for a, z in tx.slices(batch):
                rows = []
                for coded in own.encode(raw[a:z]):
                    text = own.decode(coded)
                    rows.append((len(coded) // 4, hashlib.sha256(coded).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), coded if with_output else None, text if with_output else None))
                yield pa.RecordBatch.from_arrays([ids.slice(a, z - a), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True))], names)
        if not keep:
            own.forget()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary, decoded string")
