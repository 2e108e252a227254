"""A latent space of sparse rows by randomised singular value decomposition, spread over Spark.

Rows are (row, term, weight) entries. Random signs of every term probe the rows; the probe goes back to
the terms as sums of weighted vectors, whose Gram matrix (width x width, summed by Spark) gives an
orthonormal basis; the rows in that basis have another Gram matrix, whose leading eigenvectors turn the
basis into singular vectors. Only the two Gram matrices, of fixed size, reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx

SPARE = 16
#: rows of a slice, whose vectors are in memory at once
SLICE = 1024
#: entries or partial sums that one task adds up
GROUP = 1 << 15
_VECTOR = "v binary"


def signs(terms: np.ndarray, width: int) -> np.ndarray:
    """A row of `width` random signs for every term, from the bits of its mixed hashes."""
    seeds = tx.mix(np.arange(1, -(-width // 64) + 1, dtype=np.uint64))
    bits = tx.mix(terms.view(np.uint64)[:, None] ^ seeds[None, :])
    return np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), axis=1)[:, :width] * 2.0 - 1.0


def packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows, np.float64)], pa.binary())


def unpacked(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def _sums(frame: DataFrame, key: str, groups: int) -> DataFrame:
    """(key, v): the sum of the vectors of each key, many keys to a task."""

    def run(table: pa.Table) -> pa.Table:
        own, inverse = np.unique(table.column(key).to_numpy(), return_inverse=True)
        v = unpacked(table.column("v"))
        out = np.zeros((len(own), v.shape[1]))
        np.add.at(out, inverse, v)
        return pa.table({key: pa.array(own, pa.int64()), "v": packed(out)})

    return frame.groupBy(F.pmod(F.xxhash64(key), F.lit(groups)).alias("g")).applyInArrow(run, f"{key} long, {_VECTOR}")


def gram(vectors: DataFrame) -> np.ndarray:
    """The sum of v v' over all rows of vectors (v)."""

    def run(batches):
        for batch in batches:
            v = unpacked(batch.column("v"))
            if len(v):
                product = (v.T @ v).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(product))), pa.array(product)], ["cell", "x"])

    got = vectors.select("v").mapInArrow(run, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).toPandas()
    out = np.zeros(len(got))
    out[got["cell"].to_numpy(np.int64)] = got["x"]
    width = int(np.sqrt(len(got)))
    return (lambda m: (m + m.T) / 2)(out.reshape(width, width))


def _turned(vectors: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(key), packed(unpacked(batch.column("v")) @ matrix)], [key, "v"])

    return vectors.select(key, "v").mapInArrow(run, f"{key} long, {_VECTOR}")


def decompose(entries: DataFrame, rank: int) -> tuple[DataFrame, DataFrame]:
    """(term, v) with the `rank` leading right singular vectors and (row, v) with the rows in their space; v holds doubles.

    entries (row, term, weight), each (row, term) once, a bounded number for each row, is read three
    times, so it should be a written table; empty entries give empty tables. Fewer vectors come where the rows have a lower rank.
    """
    width = rank + SPARE
    groups = -(-entries.count() // GROUP) or 1

    def probe(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                lists = batch.column("entries").slice(at, SLICE)
                flat, n = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
                terms, weight = flat.field("term").to_numpy(zero_copy_only=False), flat.field("weight").to_numpy(zero_copy_only=False)
                y = np.add.reduceat(signs(terms, width) * weight[:, None], np.concatenate([[0], np.cumsum(n)[:-1]]), axis=0)
                own, inverse = np.unique(terms, return_inverse=True)
                back = np.zeros((len(own), width))
                np.add.at(back, inverse, np.repeat(y, n, axis=0) * weight[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(own), packed(back)], ["term", "v"])

    rows = entries.groupBy("row").agg(F.collect_list(F.struct("term", "weight")).alias("entries")).select("entries")
    range_ = tx.materialized(_sums(rows.mapInArrow(probe, f"term long, {_VECTOR}"), "term", groups), "latent_range")
    values, vectors = np.linalg.eigh(gram(range_))
    use = values > max(values.max(initial=0.0), 1e-300) * 1e-10
    basis = tx.materialized(_turned(range_, "term", vectors[:, use] / np.sqrt(values[use])), "latent_basis")

    def weighted(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("row"), packed(unpacked(batch.column("v")) * batch.column("weight").to_numpy()[:, None])], ["row", "v"])

    parts = entries.join(basis, "term").select("row", "weight", "v").mapInArrow(weighted, f"row long, {_VECTOR}")
    projected = tx.materialized(_sums(parts, "row", groups), "latent_rows")
    turn = np.linalg.eigh(gram(projected))[1][:, ::-1][:, :rank]
    return tx.materialized(_turned(basis, "term", turn), "latent_terms"), tx.materialized(_turned(projected, "row", turn), "latent_turned")
