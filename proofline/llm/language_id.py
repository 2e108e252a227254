"""Language identification with string kernels.

The kernel of two texts counts the n-grams of one to three bytes (lower-cased UTF-8) that both have,
present or not, over hashed n-grams, divided by the root of the two counts. Landmark texts give a
Nystrom map into a small space, and one-versus-rest ridge regression is solved there. Texts are scored
by batched matrix products: presence times landmarks, times one small matrix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx

BUCKETS = 1 << 15
GRAMS = (1, 2, 3)
ROWS = 128
SAMPLE = 400
LANDMARKS = 128
RIDGE = 1e-2
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_LETTER = regex.compile(r"\p{L}")


def presence(texts: list[bytes]) -> np.ndarray:
    """A row for each text: 1 in the buckets of its n-grams."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    joined = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), list(map(len, texts)))
    for n, multiplier in zip(GRAMS, _MULTIPLIERS, strict=True):
        if len(joined) < n:
            break
        size = len(joined) - n + 1
        code = np.zeros(size, np.uint64)
        for i in range(n):
            code = (code << np.uint64(8)) | joined[i : i + size]
        bucket = ((code + np.uint64(1)) * np.uint64(multiplier) >> np.uint64(64 - 15)).astype(np.int64)
        whole = owner[:size] == owner[n - 1 :]
        out[owner[:size][whole], bucket[whole]] = 1
    return out


def _batches(batch: pa.RecordBatch):
    """Row numbers and presence of at most ROWS texts at a time."""
    raw = tx.as_bytes(pa.compute.utf8_lower(batch.column("text")))
    for a, z in tx.slices(batch, limit=1 << 20):
        for b in range(a, z, ROWS):
            yield b, presence(raw[b : min(z, b + ROWS)])


class Model:
    """Landmarks and weights; scores of presence rows are one column for each language."""

    def __init__(self, rows: np.ndarray, labels: list[str]) -> None:
        self.languages = sorted(set(labels))
        sizes = np.maximum(rows.sum(1), 1)
        # landmarks are spread over the languages
        turn = {}
        order = sorted(range(len(labels)), key=lambda i: (turn.setdefault(labels[i], iter(range(len(labels)))).__next__(), labels[i]))
        pick = np.array(order[:LANDMARKS])
        self.landmarks = (rows[pick] / np.sqrt(sizes[pick])[:, None]).T.astype(np.float32).copy()
        kernel = self.kernel(rows, sizes)
        values, vectors = np.linalg.eigh(kernel[pick].astype(np.float64))
        keep = values > 1e-6 * max(values.max(), 1e-12)
        root = vectors[:, keep] / np.sqrt(values[keep])
        features = kernel @ root
        target = np.where(np.array(labels)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        solved = np.linalg.solve(features.T @ features + RIDGE * len(rows) * np.eye(features.shape[1]) / 100, features.T @ target)
        self.weights = (root @ solved).astype(np.float32)

    def kernel(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return (rows @ self.landmarks) / np.sqrt(sizes)[:, None].astype(np.float32)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return self.kernel(rows, np.maximum(rows.sum(1), 1)) @ self.weights


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on about `sample` rows of each value of lang, chosen by a hash of doc_id; None without rows.

    labelled (doc_id, text, lang). Rows without text or lang are left out. What reaches the driver is
    the presence of the sampled rows, packed to bits.
    """
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map([F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample / n))])
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def pack(batches):
        for batch in batches:
            for a, rows_ in _batches(batch):
                bits = [np.packbits(r.astype(bool)).tobytes() for r in rows_]
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(a, len(rows_)), pa.array(bits, pa.binary())], ["lang", "bits"])

    got = chosen.mapInArrow(pack, "lang string, bits binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["lang"], bytes(r["bits"])))
    features = np.stack([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in got]).astype(np.float32)
    mixed = np.random.default_rng(5).permutation(len(got))
    return Model(features[mixed], [got[i]["lang"] for i in mixed])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of docs (doc_id, text), over the whole text.

    lang_pred is a learned language, or `und` with score 0 if the text is null or has no letter or
    nothing was learned. score is the best language's share after a softmax. Rows with a null doc_id and
    repeated rows stay; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            text = batch.column("text")
            for a, rows in _batches(batch):
                some = [t is not None and _LETTER.search(t) is not None for t in text.slice(a, len(rows)).to_pylist()]
                if own is None:
                    best, score = ["und"] * len(rows), np.zeros(len(rows))
                else:
                    s = own.scores(rows).astype(np.float64) * 4
                    s = np.exp(s - s.max(1, keepdims=True))
                    s /= s.sum(1, keepdims=True)
                    best = [own.languages[i] if ok else "und" for i, ok in zip(s.argmax(1), some, strict=True)]
                    score = np.where(some, s.max(1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, len(rows)), pa.array(best, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")
