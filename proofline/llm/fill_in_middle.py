"""Fill-in-the-middle training texts, cut by a learned rank index.

A text is a row of units: a word with the white space before it, or the white space at its end. The
boundaries of all units of a block of documents are one rising sequence of byte offsets. The index of a
block maps the rank of a boundary to its offset: straight segments are fitted from left to right, each as
far as one slope keeps every boundary within ERROR bytes, and the differences that are left go into one
signed byte a boundary. A cut is the prediction of its segment plus its stored difference, which is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx
from proofline.llm.chunks import ASCII_SPACE

ERROR = 63
FIRST_LOOK = 512
PLAIN_PERCENT = 50
SUFFIX_FIRST_PERCENT = 80


class RankIndex:
    """Rising offsets by rank, as segments and one byte of difference for each offset."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR) -> None:
        if not 0 <= error < 127:
            raise ValueError("the error bound and a rounding step must fit into a signed byte")
        self.first, self.base, self.slope = self._fit(offsets, error)
        ranks = np.arange(len(offsets))
        self.residual = (offsets - self._predicted(ranks)).astype(np.int8)

    @staticmethod
    def _fit(offsets: np.ndarray, error: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First rank, its offset and the slope of every segment; the cone of slopes shrinks until it is empty."""
        first, slope, at, n = [], [], 0, len(offsets)
        while at < n:
            look = FIRST_LOOK
            while True:
                rise = (offsets[at + 1 : at + 1 + look] - offsets[at]).astype(np.float64)
                run = np.arange(1, len(rise) + 1)
                low = np.maximum.accumulate((rise - error) / run)
                high = np.minimum.accumulate((rise + error) / run)
                shut = low > high
                held = int(shut.argmax()) if shut.any() else len(rise)
                if held < look or at + look >= n - 1:
                    break
                look *= 2
            first.append(at)
            slope.append((low[held - 1] + high[held - 1]) / 2 if held else 0.0)
            at += held + 1
        starts = np.array(first, np.int64)
        return starts, offsets[starts], np.array(slope)

    def _predicted(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[at] + np.rint(self.slope[at] * (ranks - self.first[at])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of the ranks."""
        return self._predicted(ranks) + self.residual[ranks]


def boundaries(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined by one byte, where each begins, all unit boundaries, and the rank of each text's first."""
    joined = b" ".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(lengths + 1) - lengths - 1
    space = ASCII_SPACE[data]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    stops = begins + lengths
    trailing = stops[(lengths > 0) & space[np.maximum(stops - 1, 0)]]
    offsets = np.sort(np.concatenate([ends, begins, trailing]))
    return joined, begins, offsets, np.searchsorted(offsets, begins)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The first four 8-digit groups of the hex sha256 of seed, colon and decimal id, as unsigned integers."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def rearrange(docs: DataFrame, seed: int = 42) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of docs (doc_id, text), over the whole text.

    n is the number of units. Both cuts are drawn from the boundaries by a hash of doc_id, so a row's result
    hangs on its id and text only. form is plain (output is the text; no character counts), psm
    (`<P>`prefix`<S>`suffix`<M>`middle) or spm (`<S>`suffix`<P>`prefix`<M>`middle). Empty texts and texts
    that hold a mark are plain; a null text counts as empty and a null doc_id as an empty id. Repeated rows
    stay, other columns are not read, no rows give no rows. A very long text is a block of its own.
    """

    def run(batches):
        for batch in batches:
            raw, ids = tx.as_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            for a, z in tx.slices(batch):
                yield _block(raw[a:z], ids[a:z], seed)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def _block(texts: list[bytes], ids: list[int | None], seed: int) -> pa.RecordBatch:
    joined, begins, offsets, first = boundaries(texts)
    n = np.diff(np.append(first, len(offsets))) - 1
    drawn = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    index = RankIndex(offsets)
    ranks = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1) + first[:, None]
    cuts = index.offsets(ranks.ravel()).reshape(-1, 2)
    points = np.concatenate([[0], np.cumsum((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80)])
    at = np.column_stack([begins, cuts])
    chars = np.diff(points[at], axis=1).tolist()
    forms, outputs = [], []
    for k, (text, (begin, one, two), (_, _, h3, h4)) in enumerate(zip(texts, at.tolist(), drawn.tolist(), strict=True)):
        if not text or h3 % 100 >= PLAIN_PERCENT or any(m in text for m in (b"<P>", b"<S>", b"<M>")):
            forms.append("plain")
            outputs.append(text)
            chars[k] = [None, None]
            continue
        prefix, middle, suffix = joined[begin:one], joined[one:two], joined[two : begin + len(text)]
        if h4 % 100 < SUFFIX_FIRST_PERCENT:
            forms.append("spm")
            outputs.append(b"".join([b"<S>", suffix, b"<P>", prefix, b"<M>", middle]))
        else:
            forms.append("psm")
            outputs.append(b"".join([b"<P>", prefix, b"<S>", suffix, b"<M>", middle]))
    columns = [
        pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array([c[0] for c in chars], pa.int64()),
        pa.array([c[1] for c in chars], pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text again from an output and its form. Marks stand in no part, so the first of each kind is the mark."""
    out, kind = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    one = F.when(kind == "psm", F.instr(out, "<S>")).otherwise(F.instr(out, "<P>"))
    two = F.instr(out, "<M>")
    left, right = F.substring(out, F.lit(4), one - 4), F.substring(out, one + 3, two - one - 3)
    middle = F.substring(out, two + 3, F.length(out))
    return F.when(kind == "psm", F.concat(left, middle, right)).when(kind == "spm", F.concat(right, middle, left)).otherwise(out)
