"""Token ids of a corpus as binary files, and reading them.

The files are Parquet tables of blocks, in ascending doc_id order over all blocks:

* `blocks`: shard, block, offset (ids before the block in its shard), n_ids, doc_ids, lengths, control,
  data. Ids are replaced by their rank in the corpus, the most frequent first, and written with as few
  bytes as they need; a control byte holds the byte counts less one of four ids, two bits each from the
  lowest, apart from the data bytes, which are little-endian.
* `ranking`: rank, id.

Control bytes are decoded by a table of 256 rows: the four byte counts of each control byte.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from proofline.llm import text as tx
from proofline.llm.chunks import ASCII_SPACE, WIDE_SPACE, ChunkMemory, mark_cuts
from proofline.session import scratch

BLOCK_IDS = 500_000
REMEMBERED = 800_000
RANGE_CHARS = 32
WIDE = re.compile(b"|".join(map(re.escape, WIDE_SPACE)))
COUNTS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


class IdEncoder:
    """Ids of texts by the tokenizers library; remembers the ids of chunks."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.bytes_of = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab().items():
            self.bytes_of[i] = len(token)
        # only the pattern of byte-level vocabularies is known to end a pre-token before a mark
        before = json.loads(self.library.to_str())["pre_tokenizer"] or {}
        cuts = mark_cuts if before.get("type") == "ByteLevel" and before.get("use_regex", True) else None
        self.memory = ChunkMemory(self._learn, self.kind, ASCII_SPACE, REMEMBERED, cuts)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, self.kind)

    def _learn(self, keys: list[bytes], whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks; whole ones go to the library as one string, as no token crosses between them.

        In a byte-level vocabulary a token has one character for each byte, so the byte counts tell
        where a chunk ends; if they do not meet the chunks, each goes alone.
        """
        if not whole:
            parts = [self._whole(k) for k in keys]
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        joined = b"".join(keys).decode()
        ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.kind)
        ends = np.cumsum(self.bytes_of[ids])
        stops = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys)))
        cuts = np.searchsorted(ends, stops) + 1
        if not np.array_equal(ends[np.minimum(cuts, len(ends)) - 1], stops):
            parts = [self._whole(k) for k in keys]
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, np.diff(cuts, prepend=0)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        plain = [(t.isascii() or not WIDE.search(t)) and not any(s in t for s in self.special) for t in texts]
        values, n = self.memory.lookup([t for t, p in zip(texts, plain, strict=True) if p])
        parts = iter(np.split(values, np.cumsum(n)[:-1]) if len(n) else [])
        return [next(parts) if p else self._whole(t) for t, p in zip(texts, plain, strict=True)]


_KEPT: dict[str, IdEncoder] = {}


def encoder(path: str) -> IdEncoder:
    if path not in _KEPT:
        _KEPT[path] = IdEncoder(path)
    return _KEPT[path]


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2**32."""
    ranks = ranks.astype(np.uint32)
    top = int(ranks.max()) if len(ranks) else 0
    over = [k for k in (1, 2, 3) if top >> 8 * k]
    sizes = np.ones(len(ranks), np.uint8)
    for k in over:
        sizes += ranks >> np.uint32(8 * k) > 0
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = sizes - 1
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    ends = np.cumsum(sizes, dtype=np.int64)
    begins = ends - sizes
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[begins] = ranks.astype(np.uint8)
    for k in over:
        more = np.flatnonzero(sizes > k)
        data[begins[more] + k] = (ranks[more] >> np.uint32(8 * k)).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks again, by looking the control bytes up in a table of byte counts."""
    sizes = COUNTS[np.frombuffer(control, np.uint8)].ravel()[:n]
    begins = np.cumsum(sizes) - sizes
    octets = np.append(np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)).astype(np.uint32)
    out = octets[begins]
    for k in range(1, int(sizes.max()) if n else 0):
        more = np.flatnonzero(sizes > k)
        out[more] |= octets[begins[more] + k] << np.uint32(8 * k)
    return out


def _encode(docs: DataFrame, path: str, end: int, size: int) -> DataFrame:
    """Blocks of plain ids; docs come in order, one shard a task. The last row of a shard counts its ids."""
    names = ["shard", "block", "offset", "doc_ids", "lengths", "ids", "seen_id", "seen"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def row(*values):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

    def run(batches):
        own, shard, block, offset = encoder(path), TaskContext.get().partitionId(), 0, 0
        tail, seen = np.array([end], own.kind), np.zeros(size, np.int64)
        ids, lengths, held, n = [], [], [], 0

        def flush():
            nonlocal block, offset, ids, lengths, held, n
            joined = np.concatenate(held)
            seen[:] += np.bincount(joined, minlength=size)
            out = row(shard, block, offset, ids, lengths, joined.tobytes(), None, None)
            block, offset = block + 1, offset + n
            ids, lengths, held, n = [], [], [], 0
            return out

        for batch in batches:
            raw, doc = tx.as_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            for a, z in tx.slices(batch):
                for d, coded in zip(doc[a:z], own.encode(raw[a:z]), strict=True):
                    ids.append(d)
                    held += [coded, tail]
                    lengths.append(len(coded) + 1)
                    n += len(coded) + 1
                if n > BLOCK_IDS:
                    yield flush()
        if ids:
            yield flush()
        some = np.flatnonzero(seen)
        if len(some):
            yield row(shard, None, None, None, None, None, some, seen[some])

    return docs.mapInArrow(run, "shard int, block long, offset long, doc_ids array<long>, lengths array<long>, ids binary, seen_id array<long>, seen array<long>")


def write_tokens(docs: DataFrame, path: str, folder: str, end: int = 2) -> None:
    """Write the ids of every row of docs (doc_id, text), each followed by `end`, into the folder.

    path: a vocabulary file of the tokenizers library on every node. No special tokens are added. A null
    text counts as empty. Rows with a null doc_id come first; rows with one doc_id go by text, and those
    that differ in its first RANGE_CHARS characters may go to different tasks. No rows give empty files.
    Other columns are ignored. The ranking has a row for each id of the vocabulary and is broadcast.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_id = F.col("doc_id").asc_nulls_first()
    ordered = docs.repartitionByRange(parts, by_id, F.substring("text", 1, RANGE_CHARS).asc_nulls_first()).sortWithinPartitions(by_id, F.col("text").asc_nulls_first())
    library = Tokenizer.from_file(path)
    size, kind = max(library.get_vocab_size(), end + 1), np.dtype("<u2") if library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
    plain = scratch(spark, "ids")
    _encode(ordered, path, end, size).write.option("compression", "snappy").parquet(plain)
    written = spark.read.parquet(plain)
    blocks = written.where("block is not null").drop("seen_id", "seen")
    counted = written.where("seen is not null").select(F.explode(F.arrays_zip("seen_id", "seen")).alias("c"))
    got = counted.groupBy(F.col("c.seen_id").alias("id")).agg(F.sum("c.seen").alias("n")).toPandas()
    seen = np.zeros(size, np.int64)
    seen[got["id"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    order = np.lexsort((np.arange(size), -seen))
    rank = np.empty(size, np.uint32)
    rank[order] = np.arange(size, dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank)
    names = ["shard", "block", "offset", "n_ids", "doc_ids", "lengths", "control", "data"]

    def code(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = np.frombuffer(row.column("ids")[0].as_buffer(), kind)
                control, data = pack(ranks.value[ids])
                yield pa.RecordBatch.from_arrays([*(row.column(n) for n in names[:3]), pa.array([len(ids)], pa.int64()), row.column("doc_ids"), row.column("lengths"), pa.array([control], pa.binary()), pa.array([data], pa.binary())], names)

    schema = "shard int, block long, offset long, n_ids long, doc_ids array<long>, lengths array<long>, control binary, data binary"
    blocks.mapInArrow(code, schema).write.option("compression", "zstd").parquet(f"{folder}/blocks")
    spark.createDataFrame(list(enumerate(order.tolist())), "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranking")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of the files.

    start is the number of ids of all documents before it; the driver gets one row for each shard.
    ids (little-endian unsigned 32-bit) are filled if with_ids.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    ranking = spark.read.parquet(f"{folder}/ranking").toPandas().sort_values("rank")["id"].to_numpy()
    table = spark.sparkContext.broadcast(ranking.astype("<u4"))
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).toPandas().sort_values("shard")
    bases = spark.sparkContext.broadcast(dict(zip(totals["shard"].tolist(), (totals["n"].cumsum() - totals["n"]).tolist(), strict=True)))

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                shard, offset, n, control, data = (batch.column(c)[r].as_py() for c in ("shard", "offset", "n_ids", "control", "data"))
                doc_ids, lengths = batch.column("doc_ids")[r].values, batch.column("lengths")[r].values.to_numpy()
                raw = table.value[unpack(control, data, n)].tobytes()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                cut = [raw[4 * a : 4 * z] for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(starts + offset + bases.value[shard]), pa.array(lengths), pa.array([zlib.crc32(c) for c in cut], pa.int64()), pa.array(cut if with_ids else [None] * len(cut), pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    columns = ["shard", "offset", "n_ids", "doc_ids", "lengths", "control", "data"]
    return blocks.select(columns).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
