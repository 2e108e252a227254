"""Hard negatives by exact integer scores in a residue number system.

Components are whole numbers after scaling. Modulo a small prime they fit into a few bits, so the product
of two matrices of residues is exact in float32 while no sum passes 2**24; long vectors go in slices of
dimensions that keep to it. Products modulo several primes give the exact signed score by Chinese
remaindering (mixed radix with signed digits). As many primes are used as the largest score needs.

Anchors go in blocks. One pass over all rows finds each anchor's positives, a second one selects in the
window that each positive opens: every task keeps the best few of each window, and the best of all tasks
are ranked.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proofline.llm import text as tx
from proofline.llm.topk import top_of
from proofline.session import scratch

ANCHORS = 16_384
SIDE = 1024
WHOLE = 1 << 24


def _primes(below: int) -> list[int]:
    """The odd primes below the bound, the largest first."""
    sieve = np.ones(below, bool)
    sieve[:3] = False
    sieve[4::2] = False
    for k in range(3, math.isqrt(below) + 1, 2):
        if sieve[k]:
            sieve[k * k :: k] = False
    return np.flatnonzero(sieve)[::-1].tolist()


PRIMES = _primes(1024)


def residues(v: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers (as doubles) modulo an odd p, between -(p-1)/2 and (p-1)/2."""
    r = np.fmod(v, p)
    return (r - p * np.rint(r / p)).astype(np.float32)


def product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """The products of the rows of a and b modulo p, between -(p-1)/2 and (p-1)/2."""
    step = (WHOLE - 1) // (p // 2) ** 2
    total = np.zeros((len(a), len(b)), np.float32)
    x, y = residues(a, p), residues(b, p)
    for k in range(0, a.shape[1], step):
        part = x[:, k : k + step] @ y[:, k : k + step].T
        total += part - np.float32(p) * np.rint(part / np.float32(p))
    total = total.astype(np.int32) % p
    return np.where(total > p // 2, total - p, total)


def norm(v: np.ndarray) -> float:
    return float(np.sqrt((v * v).sum(1).max(initial=0.0)))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a and b, whole numbers as doubles. One beyond 64 bits raises."""
    bound = norm(a) * norm(b) * (1 + 1e-9) + 1
    if not math.isfinite(bound):
        raise ValueError("a score does not fit into 64 bits")
    primes, whole = [], 1
    for p in PRIMES:
        if whole > 2 * bound:
            break
        primes.append(p)
        whole *= p
    if whole <= 2 * bound:
        raise ValueError("a score does not fit into 64 bits")
    big = bound >= 1 << 63
    out = np.zeros((len(a), len(b)), object if big else np.int64)
    digits: list[np.ndarray] = []
    weight = 1
    for k, p in enumerate(primes):
        rest, scale = product(a, b, p).astype(np.int64), 1
        for digit, q in zip(digits, primes, strict=False):
            rest -= digit * scale % p
            scale = scale * q % p
        digit = rest * pow(scale, -1, p) % p
        digit = np.where(digit > p // 2, digit - p, digit)
        digits.append(digit)
        # the sum fits at the end, so what passes 64 bits on the way cancels
        out += digit.astype(object) * weight if big else digit * np.int64((weight + (1 << 63)) % (1 << 64) - (1 << 63))
        weight *= primes[k]
    if big and out.size and max(abs(int(out.max())), abs(int(out.min()))) >= 1 << 63:
        raise ValueError("a score does not fit into 64 bits")
    return out.astype(np.int64)


def scaled(batch: pa.RecordBatch, factor: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By dimension: vec_id, label and floor(factor * x) of the rows that take part."""
    column = batch.column("embedding")
    valid = np.asarray(column.is_valid()) & np.asarray(batch.column("vec_id").is_valid()) & np.asarray(batch.column("label").is_valid())
    lengths = np.asarray(column.value_lengths().fill_null(0))
    values = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan), np.float64)
    ends = np.cumsum(lengths)
    ids, labels = (np.asarray(batch.column(c).fill_null(0), np.int64) for c in ("vec_id", "label"))
    out = {}
    for d in np.unique(lengths[valid]):
        rows = np.flatnonzero(valid & (lengths == d))
        part = values[(ends[rows] - d)[:, None] + np.arange(d)]
        rows, part = rows[good := np.isfinite(part).all(1)], part[good]
        out[int(d)] = ids[rows], labels[rows], np.floor(factor * part)
    return out


class Block:
    """A block of anchors, by dimension: their numbers in the block, ids, labels and vectors."""

    def __init__(self, rows: list, factor: int) -> None:
        batch = pa.RecordBatch.from_arrays(
            [pa.array([r["vec_id"] for r in rows], pa.int64()), pa.array([r["label"] for r in rows], pa.int64()), pa.array([list(r["embedding"]) for r in rows], pa.list_(pa.float64()))],
            ["vec_id", "label", "embedding"],
        )
        self.factor, self.ids, self.parts = factor, [], {}
        for d, (ids, labels, vectors) in scaled(batch, factor).items():
            self.parts[d] = np.arange(len(self.ids), len(self.ids) + len(ids)), ids, labels, vectors
            self.ids += ids.tolist()

    def scored(self, batch: pa.RecordBatch):
        """(anchor numbers, row ids, scores, same label, other row) of pieces of SIDE rows and anchors."""
        for d, (ids, labels, vectors) in scaled(batch, self.factor).items():
            if d not in self.parts:
                continue
            numbers, own, marks, matrix = self.parts[d]
            for a in range(0, len(ids), SIDE):
                row = slice(a, a + SIDE)
                for b in range(0, len(numbers), SIDE):
                    col = slice(b, b + SIDE)
                    yield numbers[col], ids[row], scores(vectors[row], matrix[col]), labels[row, None] == marks[None, col], ids[row, None] != own[None, col]


class Best:
    """The first k (score, vec_id) of each of n groups so far; `least` is what a new score must reach."""

    def __init__(self, n: int, k: int, least: np.ndarray) -> None:
        self.k, self.least, self.rows, self.kept = k, least.copy(), np.zeros((0, 3), np.int64), 0

    def add(self, groups: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        self.rows = np.concatenate([self.rows, np.stack([groups, found, ids], 1)])
        if len(self.rows) > 2 * self.kept + 100_000:
            self.settle()

    def settle(self) -> np.ndarray:
        self.rows = top_of(self.rows, self.k)
        self.kept = len(self.rows)
        begins = np.flatnonzero(np.concatenate([[True], self.rows[1:, 0] != self.rows[:-1, 0]])) if self.kept else np.zeros(0, np.int64)
        ends = np.append(begins, self.kept)[1:] - 1
        full = ends - begins == self.k - 1
        self.least[self.rows[begins[full], 0]] = self.rows[ends[full], 1]
        return self.rows


def _positives(rows: DataFrame, block, k: int) -> DataFrame:
    """(anchor, rank, score, vec_id): the first k other rows of each anchor's label."""

    def run(batches):
        own, n = block.value, len(block.value.ids)
        best = Best(n, k, np.full(n, np.iinfo(np.int64).min))
        for batch in batches:
            for numbers, ids, found, same, other in own.scored(batch):
                i, j = np.nonzero(same & other & (found >= best.least[numbers]))
                best.add(numbers[j], found[i, j], ids[i])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.settle().T.copy()], ["anchor", "score", "vec_id"])

    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "vec_id")
    found = rows.mapInArrow(run, "anchor long, score long, vec_id long")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _negatives(rows: DataFrame, block, low: np.ndarray, high: np.ndarray, k: int) -> DataFrame:
    """(place, rank, score, vec_id): the first k rows of other labels with low <= score <= high.

    low and high are (anchors, positives) arrays, a place is a number in them; low above high takes none.
    """

    def run(batches):
        own = block.value
        best = Best(low.size, k, low.ravel())
        for batch in batches:
            for numbers, ids, found, same, _ in own.scored(batch):
                for p in range(low.shape[1]):
                    place = numbers * low.shape[1] + p
                    i, j = np.nonzero(~same & (found <= high[numbers, p]) & (found >= best.least[place]))
                    best.add(place[j], found[i, j], ids[i])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.settle().T.copy()], ["place", "score", "vec_id"])

    order = Window.partitionBy("place").orderBy(F.col("score").desc(), "vec_id")
    found = rows.mapInArrow(run, "place long, score long, vec_id long")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 5, percent: int = 80, factor: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), rank from 1 for each pair.

    vectors (vec_id, embedding, label); is_anchor is a condition on them. Components become
    floor(factor * x), scores are inner products; higher ones come first, ties go to the smaller vec_id. An
    anchor's positives are its first rows of the same label, its negatives for a positive the first rows of
    other labels that score from `percent` of the positive's score up to it (none below a score of 0). Rows
    with a null id, label or vector, or a null or non-finite component, take no part, nor do rows of another
    number of components than the anchor or of its own id. Repeated rows are each ranked; a repeated anchor
    counts once, and different rows under one anchor id are an anchor each. Scores beyond 64 bits raise.
    Other columns are ignored; no rows give no rows. The driver holds one block of ANCHORS at a time.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where("vec_id is not null and label is not null and embedding is not null")
    anchors = vectors.where(is_anchor).dropDuplicates()
    blocks = max(1, -(-anchors.count() // ANCHORS))
    dealt = scratch(spark, "anchors")
    anchors.repartitionByRange(blocks, "vec_id", "label", "embedding").withColumn("block", F.spark_partition_id()).write.parquet(dealt)
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for number in range(blocks):
        held = spark.read.parquet(dealt).where(F.col("block") == number).orderBy("vec_id", "label", "embedding").collect()
        own = Block(held, factor)
        if not own.ids:
            continue
        block = spark.sparkContext.broadcast(own)
        first = _positives(vectors, block, positives).collect()
        low, high = np.ones((len(own.ids), positives), np.int64), np.zeros((len(own.ids), positives), np.int64)
        for r in first:
            if r["score"] >= 0:
                low[r["anchor"], r["rank"] - 1] = -(-percent * r["score"] // 100)
                high[r["anchor"], r["rank"] - 1] = r["score"]
        names = [(r["anchor"] * positives + r["rank"] - 1, own.ids[r["anchor"]], r["vec_id"], r["score"]) for r in first]
        pairs = spark.createDataFrame(names, "place long, anchor_id long, positive_id long, positive_score long")
        found = _negatives(vectors, block, low, high, negatives).join(F.broadcast(pairs), "place")
        out = out.union(found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    return out
