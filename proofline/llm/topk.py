"""Exact top-k inner products by distributed histogram selection.

Queries go in blocks of bounded size; each pass scores all vectors against a block by matrix products.
The first passes only count: every task counts its scores by bins of the interval in which a query's
k-th best score can lie, the sums over all tasks locate the bin that holds it, and the next pass splits
that bin. When the bins down to it hold few scores, or one value, the last pass keeps the scores from
there up and ranks them. A task reports a query's bins from the top down only until it has counted k
scores of its own: the k-th best of all cannot lie below, so the answer stays exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proofline.llm import text as tx
from proofline.session import scratch

QUERY_BLOCK = 2048
BINS = 1024
SLICE = 2048
EXACT = 1 << 53


def scaled(column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: row numbers and floor(1024 * x) of the vectors without null or non-finite components."""
    valid, lengths = np.asarray(column.is_valid()), np.asarray(column.value_lengths().fill_null(0))
    out = {}
    flat = column.flatten()
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan), np.float64)
    ends = np.cumsum(lengths)
    for d in np.unique(lengths[valid]):
        rows = np.flatnonzero(valid & (lengths == d))
        part = values[(ends[rows] - d)[:, None] + np.arange(d)]
        good = np.isfinite(part).all(1)
        out[int(d)] = rows[good], np.floor(1024 * part[good])
    return out


def scores(candidates: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles hold them exactly while they stay below 2**53."""
    d = candidates.shape[1]
    bound = d * float(np.abs(candidates).max(initial=0)) * float(np.abs(queries).max(initial=0))
    if bound < EXACT:
        return (candidates @ queries.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    big = exact(candidates).dot(exact(queries).T) if candidates.size and queries.size else np.zeros((len(candidates), len(queries)), object)
    if big.size and max(abs(int(big.max())), abs(int(big.min()))) >= 1 << 63:
        raise ValueError("a score does not fit into 64 bits")
    return big.astype(np.int64)


class Block:
    """A block of queries: ids, and by dimension the numbers and vectors of its queries."""

    def __init__(self, ids: list[int], vectors: list[list[float]]) -> None:
        self.ids = np.array(ids, np.int64)
        self.parts = scaled(pa.array(vectors, pa.list_(pa.float64())))

    def scored(self, batch: pa.RecordBatch):
        """(query numbers, candidate ids, scores) of slices; a query's own rows score as absent (mask)."""
        ids = batch.column("vec_id")
        known = np.asarray(ids.is_valid())
        numbers = np.asarray(ids.fill_null(0), np.int64)
        for d, (rows, vectors) in scaled(batch.column("embedding")).items():
            if d not in self.parts or not len(self.parts[d][0]):
                continue
            take = known[rows]
            rows, vectors = rows[take], vectors[take]
            queries, matrix = self.parts[d]
            for a in range(0, len(rows), SLICE):
                own = numbers[rows[a : a + SLICE]]
                yield queries, own, scores(vectors[a : a + SLICE], matrix), own[:, None] != self.ids[queries][None, :]


def top_of(rows: np.ndarray, k: int) -> np.ndarray:
    """The first k of each query of (query, score, vec_id) rows, by falling score, then rising id."""
    rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
    begins = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])) if len(rows) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, len(rows)))
    return rows[np.arange(len(rows)) - np.repeat(begins, sizes) < k]


def _histogram(vectors: DataFrame, block, low, width, need) -> DataFrame:
    """(query, bin, n) summed over all tasks; bins count up from low, the last one takes all above."""

    def run(batches):
        b, lo, w, want = block.value, low, width, need
        seen = np.zeros((len(b.ids), BINS), np.int64)
        for batch in batches:
            for queries, _, s, other in b.scored(batch):
                bin_ = np.clip((s - lo[queries]) // w[queries], -1, BINS - 1)
                flat = (queries[None, :] * BINS + bin_)[other & (bin_ >= 0)]
                seen += np.bincount(flat, minlength=seen.size).reshape(seen.shape)
        above = np.cumsum(seen[:, ::-1], 1)[:, ::-1] - seen
        q, i = np.nonzero((seen > 0) & (above < want[:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(seen[q, i])], ["query", "bin", "n"])

    return vectors.mapInArrow(run, "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))


def _select(vectors: DataFrame, block, limit: int, k: int) -> np.ndarray:
    """For each query a score that at least k candidates reach and few exceed; the least possible if fewer exist."""
    n = len(block.value.ids)
    low, span = np.full(n, -limit, np.int64), np.full(n, 2 * limit + 1, np.int64)
    out = low.copy()
    open_ = np.ones(n, bool)
    while open_.any():
        width = np.maximum(1, -(-span // BINS))
        found = _histogram(vectors, block, low, width, np.full(n, k))
        down = Window.partitionBy("query").orderBy(F.col("bin").desc())
        summed = found.withColumn("total", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        first = summed.where(F.col("total") >= k).groupBy("query").agg(F.max(F.struct("bin", "total")).alias("m")).select("query", "m.*").collect()
        reached = np.zeros(n, bool)
        for r in first:
            q = r["query"]
            reached[q] = True
            if open_[q]:
                low[q] = out[q] = low[q] + r["bin"] * width[q]
                span[q] = width[q]
                # scores above the bin stay in the last bin of the next pass
                open_[q] = width[q] > 1 and r["total"] > 4 * k
        open_ &= reached
    return out


def _best(vectors: DataFrame, block, least: np.ndarray, k: int) -> DataFrame:
    def run(batches):
        b, held = block.value, np.zeros((0, 3), np.int64)
        for batch in batches:
            for queries, own, s, other in b.scored(batch):
                i, j = np.nonzero(other & (s >= least[queries][None, :]))
                held = np.concatenate([held, np.stack([queries[j], s[i, j], own[i]], 1)])
                if len(held) > 200_000:
                    held = top_of(held, k)
        held = top_of(held, k)
        yield pa.RecordBatch.from_arrays([pa.array(held[:, 0]), pa.array(held[:, 1]), pa.array(held[:, 2])], ["query", "score", "vec_id"])

    ranked = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    names = vectors.sparkSession.createDataFrame([(i, int(q)) for i, q in enumerate(block.value.ids)], "query long, query_id long")
    top = vectors.mapInArrow(run, "query long, score long, vec_id long").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return top.join(F.broadcast(names), "query").select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every query, all if there are fewer.

    vectors (vec_id, embedding); is_query is a condition on them. Components become floor(1024 * x).
    Candidates of a query are the rows with another vec_id and as many components; ties go to the
    smaller vec_id. Null ids, null vectors, and vectors with null or non-finite components take no part.
    Repeated candidate rows are each ranked; a repeated query row counts once, and different vectors
    under one query id are a query each. Scores beyond 64 bits raise. Other columns are ignored. Queries
    go through in blocks of about QUERY_BLOCK, one of which the driver holds at a time.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    queries = vectors.where(is_query & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).dropDuplicates()
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    dealt = scratch(spark, "queries")
    queries.repartitionByRange(blocks, "vec_id").withColumn("block", F.spark_partition_id()).write.parquet(dealt)

    def largest(batches):
        most = 0.0
        for batch in batches:
            for _, v in scaled(batch.column("embedding")).values():
                most = max(most, v.shape[1] * float(np.abs(v).max(initial=0)) ** 2)
        yield pa.RecordBatch.from_arrays([pa.array([most])], ["most"])

    most = vectors.mapInArrow(largest, "most double").agg(F.max("most")).first()[0] or 0.0
    limit = int(min(most, (1 << 62) - 1)) + 1
    out = empty
    for number in range(blocks):
        rows = spark.read.parquet(dealt).where(F.col("block") == number).orderBy("vec_id", "embedding").collect()
        own = Block([r["vec_id"] for r in rows], [list(r["embedding"]) for r in rows])
        if not any(len(q) for q, _ in own.parts.values()):
            continue
        block = spark.sparkContext.broadcast(own)
        least = _select(vectors, block, limit, k)
        out = out.union(_best(vectors, block, least, k))
    return out
