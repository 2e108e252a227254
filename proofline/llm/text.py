"""Helpers of the operators: word hashes of batches, reading tables, scratch tables.

Words are the maximal runs of bytes outside space, tab, line feed, vertical tab, form feed and
carriage return; in UTF-8 these bytes occur in no other character. A word's hash is a polynomial
over 64 bits with a random value for each byte, computed for a whole batch at once.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from proofline.session import scratch

BATCH_BYTES = 1 << 21
KEPT_POWERS = 10 << 18
_BASE = 0x9E3779B97F4A7C15
_GRAM_BASE = 0xD1342543DE82EF95
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i <= n, modulo 2**64; a worker keeps them up to KEPT_POWERS, longer ones go with their text."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = -(-(n + 1) // (1 << 18)) << 18
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size <= KEPT_POWERS:
            _POWERS[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes], fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: word hashes, the number of words before each text (and in all), starts and ends.

    Starts and ends are byte offsets inside the word's own text. fold: A-Z count as a-z.
    """
    joined = b" ".join([*texts, b""])
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] if len(texts) else np.zeros(0, np.int64)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = range_hashes(data, starts, ends, _FOLDED if fold else _VALUES)
    offsets = np.concatenate([np.searchsorted(starts, begins), [len(starts)]]).astype(np.int64)
    own = np.repeat(begins, np.diff(offsets))
    return hashes, offsets, starts - own, ends - own


def range_hashes(data: np.ndarray, a: np.ndarray, z: np.ndarray, values: np.ndarray = _VALUES) -> np.ndarray:
    """Hashes of the byte ranges a to z."""
    up, down = _powers(_BASE, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=total[1:])
    return mix((total[z] - total[a]) * down[a] + (z - a).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int, base: int = _GRAM_BASE) -> np.ndarray:
    """The hash of every run of k words; none if there are fewer words."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[: n - k + 1])


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of the batch with about `limit` bytes of the column each, at least one row."""
    sizes = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield begin, i
            begin, held = i, 0
        held += int(size) + 1
    if begin < len(sizes):
        yield begin, len(sizes)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def free(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores added until no column has it, whatever its case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable on executors that do not have it; once for each session's context."""
    context = spark.sparkContext
    if not getattr(context, "_proofline_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "proofline_package.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(path)
        context._proofline_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialized(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again, which cuts its lineage.

    The driver's garbage is collected afterwards, as Spark drops the shuffle files of a finished step
    only when the driver has forgotten it.
    """
    path = scratch(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    frame.sparkSession.sparkContext._jvm.System.gc()
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
