"""Toxicity by compression distance to two zstandard dictionaries.

A window is a lower-cased word (long words are cut into overlapping windows) repeated to a fixed number
of bytes, as zstandard stores shorter inputs as they are. The toxic dictionary is made of the windows
that stand in many different contexts of toxic texts and in few of ordinary ones, the ordinary dictionary
of those most frequent in ordinary texts. (The library's own dictionary trainer cuts samples into
pieces and keeps only frequent ones; whole windows chosen by their contexts separate far better.) A
window's distance is its compressed length with the ordinary dictionary less that with the toxic one.
A text counts by its largest distance, against a threshold calibrated on the learning rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx
from proofline.llm.chunks import ASCII_SPACE, ChunkMemory

SAMPLE_TOXIC = 3000
SAMPLE_ORDINARY = 6000
WINDOW = 32
TOXIC_WINDOWS = 2048
ORDINARY_WINDOWS = 4096
CONTEXTS = 5
CONTRAST = 12
LEVEL = 12
REMEMBERED = 200_000
PAIR_BYTES = 1 << 18
_EDGES = b".,!?;:\"'()[]{}<>*-_"


def tiled(word: bytes) -> bytes:
    return ((b"|" + word) * WINDOW)[:WINDOW]


def pieces(word: bytes) -> list[bytes]:
    """The parts of a word that make a window each: one, or several that overlap by half if it is longer than a window."""
    word = word.strip(_EDGES)
    step = WINDOW // 2
    return [word[i : i + WINDOW - 1] for i in range(0, max(1, len(word) - step), step)] if word else []


def windows(word: bytes) -> list[bytes]:
    return [tiled(p) for p in pieces(word)]


class Distance:
    """Distances of texts; remembers about REMEMBERED words."""

    def __init__(self, toxic: list[bytes], ordinary: list[bytes]) -> None:
        self.both = [self._compressor(d) for d in (toxic, ordinary)]
        self.memory = ChunkMemory(self._learn, np.int16, ASCII_SPACE, REMEMBERED)

    @staticmethod
    def _compressor(found: list[bytes]) -> zstandard.ZstdCompressor:
        content = b"".join(reversed(found)) or b"|" * WINDOW  # the most frequent ones stand nearest
        options = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=WINDOW, dict_size=len(content), window_log=18, hash_log=18, chain_log=18, search_log=7, min_match=4,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=options)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=options)

    def of(self, word: bytes) -> int:
        toxic, ordinary = self.both
        return max((len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(word)), default=-WINDOW)

    def _learn(self, keys: list[bytes], whole: bool) -> tuple[np.ndarray, np.ndarray]:
        return np.array([self.of(k.strip()) for k in keys], np.int16), np.ones(len(keys), np.int64)

    def largest(self, texts: list[bytes]) -> np.ndarray:
        """The largest distance in each text, -WINDOW without windows."""
        values, n = self.memory.lookup(texts)
        out = np.full(len(texts), -WINDOW, np.int64)
        some = np.flatnonzero(n)
        if len(some):
            out[some] = np.maximum.reduceat(values, (np.cumsum(n) - n)[some])
        return out


def _largest(docs: DataFrame, shared, columns: str) -> DataFrame:
    keep = [c.split()[0] for c in columns.split(",")]

    def run(batches):
        own = Distance(shared.value["toxic"], shared.value["ordinary"])  # goes with the task
        for batch in batches:
            for a, z in tx.slices(batch):
                part = batch.slice(a, z - a)
                found = own.largest(tx.as_bytes(pa.compute.utf8_lower(part.column("text"))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(found, pa.int64())], [*keep, "distance"])

    return docs.select(*keep, "text").mapInArrow(run, f"{columns}, distance long")


def _contexts(rows: DataFrame) -> DataFrame:
    """(word, bad, good): in how many different contexts (the word before) a window's word or part stands, by label."""

    def run(batches):
        for batch in batches:
            for a, z in tx.slices(batch, limit=PAIR_BYTES):
                part, found = batch.slice(a, z - a), set()
                for text, mark in zip(tx.as_bytes(pa.compute.utf8_lower(part.column("text"))), part.column("toxic").to_pylist(), strict=True):
                    own = text.split()
                    found.update((p, b, mark) for b, w in zip([b"", *own], own, strict=False) for p in pieces(w))
                cols = list(zip(*found, strict=True)) if found else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int32())], ["word", "before", "toxic"])

    pairs = rows.mapInArrow(run, "word binary, before binary, toxic int").select("word", F.xxhash64("before").alias("before"), "toxic").distinct()
    return pairs.groupBy("word").agg(F.sum(F.expr("int(toxic = 1)")).alias("bad"), F.sum(F.expr("int(toxic = 0)")).alias("good"))


def sampled_labels(labels: DataFrame, toxic: int = SAMPLE_TOXIC, ordinary: int = SAMPLE_ORDINARY) -> DataFrame:
    """(doc_id, toxic) of about `toxic` and `ordinary` ids of labels (doc_id, toxic), chosen by a hash of doc_id.

    Equal rows count once; null ids, other labels than 0 and 1, and ids with both labels are left out.
    """
    marks = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("high"))
    marks = marks.where("toxic = high").select("doc_id", "toxic")
    counts = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, toxic / counts.get(1, 1)))).otherwise(F.lit(min(1.0, ordinary / counts.get(0, 1))))
    return marks.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1_000_000)) < share * 1_000_000)


def fit(labelled: DataFrame, toxic: int = SAMPLE_TOXIC, ordinary: int = SAMPLE_ORDINARY) -> dict | None:
    """Learn from about `toxic` and `ordinary` rows of labelled (doc_id, text, toxic), chosen by a hash of doc_id and text.

    Rows without text or label are left out; None if a label is missing altogether. The driver gets at
    most TOXIC_WINDOWS and ORDINARY_WINDOWS words and one row for each label and distance.
    """
    rows = labelled.where("text is not null and toxic in (0, 1)").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, toxic / counts[1]))).otherwise(F.lit(min(1.0, ordinary / counts[0])))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(12)), F.lit(1_000_000)) < share * 1_000_000)
    chosen = tx.materialized(picked.repartition(parts, F.xxhash64("doc_id", "text")), "labelled")
    n = {r["toxic"]: r["n"] for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    words = tx.materialized(_contexts(chosen), "contexts")
    ratio = CONTRAST * n.get(1, 0) / max(1, n.get(0, 0))
    bad = words.where((F.col("bad") >= CONTEXTS) & (F.col("bad") >= ratio * (F.col("good") + 1)))
    bad = bad.orderBy(F.col("bad").desc(), "word").limit(TOXIC_WINDOWS).collect()
    good = words.orderBy(F.col("good").desc(), "word").limit(ORDINARY_WINDOWS).collect()
    taken = {bytes(r["word"]) for r in bad}
    model = {"toxic": [tiled(bytes(r["word"])) for r in bad], "ordinary": [tiled(bytes(r["word"])) for r in good if bytes(r["word"]) not in taken]}
    model["name"] = hash((tuple(model["toxic"]), tuple(model["ordinary"])))
    model["threshold"] = WINDOW
    found = _largest(chosen, labelled.sparkSession.sparkContext.broadcast(model), "toxic int").groupBy("toxic", "distance").agg(F.count("*").alias("n")).collect()
    best = (0.0, WINDOW + 1)  # rejects nothing unless some distance tells the labels apart
    for t in sorted({r["distance"] for r in found}):
        hit = [sum(r["n"] for r in found if r["toxic"] == c and r["distance"] >= t) / max(1, n.get(c, 0)) for c in (0, 1)]
        best = max(best, (hit[1] - hit[0], t))
    model["threshold"] = best[1]
    return model


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, score, predicted) for every row of docs (doc_id, text), over the whole text.

    score is a logistic function of the largest distance that is 0.5 or more from the threshold on;
    predicted is 1 there, else 0. Null and empty texts and texts without windows score near 0, and 0 if
    nothing was learned. Rows with a null doc_id and repeated rows stay; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    found = _largest(docs, docs.sparkSession.sparkContext.broadcast(model), "doc_id long")
    value = 1 / (1 + F.exp(-1.5 * (F.col("distance") - model["threshold"] + 0.5)))
    return found.select("doc_id", value.alias("score"), F.expr(f"int(distance >= {model['threshold']})").alias("predicted"))


def without_toxic(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of docs whose text the model does not reject, with all their columns.

    Null and empty texts stay, as do rows with a null doc_id and repeated rows; all stay without a model.
    A long text is judged whole.
    """
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = Distance(shared.value["toxic"], shared.value["ordinary"])  # goes with the task
        for batch in batches:
            for a, z in tx.slices(batch):
                part = batch.slice(a, z - a)
                found = own.largest(tx.as_bytes(pa.compute.utf8_lower(part.column("text"))))
                yield part.filter(pa.array(found < model["threshold"], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
