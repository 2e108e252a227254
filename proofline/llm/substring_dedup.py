"""Removal of repeated word sequences by suffix automata of reference shards.

A reference holds each repeated window of words once, in the document with the smallest id that has
it. Shards of the reference become suffix automata; documents stream through the automaton of the
shard their passages belong to, and the length of the current match (the matching statistic) tells at
every word whether the last `window` words stand in the reference and in which smallest document.

Which passages can repeat at all is settled without moving texts: of every `window` words the document
picks one short run by the order of hashes (winnowing), so two documents with a common window pick the
same run in it. Runs picked in two different texts mark candidates; only their surroundings, the
segments, go further. Equal texts and equal segments are named by digests, and each is looked at once, in
its smallest document: of a text of a smaller document, and of a segment of one, every window is
removable. The window's picked run also names the shard, so a window and its reference always meet.
Reference passages are the windows a grouped minimum over window hashes assigns to a document; a frequent
passage is one row for each task there. Streams of a busy shard are split among several copies of its
automaton.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx

PICKED = 8
SHARD_WORDS = 40_000
STREAM_WORDS = 40_000


class Automaton:
    """Suffix automaton of word sequences; every state knows the smallest owner of its sequences.

    Most states have one way out, kept in two arrays; further ways go to a dictionary of the state.
    """

    def __init__(self) -> None:
        self.length, self.link, self.owner = [0], [-1], [None]
        self.word, self.to, self.more = [-1], [-1], {}
        self.ids: dict[bytes, int] = {}

    def step(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.to[state]
        more = self.more.get(state)
        return more.get(word, -1) if more else -1

    def _set(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.to[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def _new(self, length: int, owner) -> int:
        self.length.append(length)
        self.link.append(0)
        self.owner.append(owner)
        self.word.append(-1)
        self.to.append(-1)
        return len(self.length) - 1

    def _clone(self, q: int, length: int) -> int:
        copy = self._new(length, None)
        self.word[copy], self.to[copy] = self.word[q], self.to[q]
        if q in self.more:
            self.more[copy] = dict(self.more[q])
        self.link[copy] = self.link[q]
        self.link[q] = copy
        return copy

    def _redirect(self, p: int, word: int, q: int, to: int) -> None:
        while p >= 0 and self.step(p, word) == q:
            self._set(p, word, to)
            p = self.link[p]

    def add(self, words: list[bytes], owner: int) -> None:
        """Append one sequence; sequences do not run into each other."""
        last = 0
        for w in words:
            word = self.ids.setdefault(w, len(self.ids))
            q = self.step(last, word)
            if q >= 0:
                if self.length[q] == self.length[last] + 1:
                    cur = q
                else:
                    cur = self._clone(q, self.length[last] + 1)
                    self._redirect(last, word, q, cur)
                if self.owner[cur] is None or owner < self.owner[cur]:
                    self.owner[cur] = owner
                last = cur
                continue
            cur, p = self._new(self.length[last] + 1, owner), last
            while p >= 0 and (q := self.step(p, word)) < 0:
                self._set(p, word, cur)
                p = self.link[p]
            if p < 0:
                self.link[cur] = 0
            elif self.length[q] == self.length[p] + 1:
                self.link[cur] = q
            else:
                copy = self._clone(q, self.length[p] + 1)
                self._redirect(p, word, q, copy)
                self.link[cur] = copy
            last = cur

    def finish(self) -> None:
        """Give every state the smallest owner of the sequences it stands for."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up, own = self.link[state], self.owner[state]
            if up > 0 and own is not None and (self.owner[up] is None or own < self.owner[up]):
                self.owner[up] = own

    def covered(self, words: list[bytes], window: int, doc: int) -> Iterator[int]:
        """The starts of windows of the document that a smaller document owns."""
        state, matched = 0, 0
        ids, length, link = self.ids, self.length, self.link
        for i, w in enumerate(words):
            word = ids.get(w, -1)
            if word < 0:
                state, matched = 0, 0
                continue
            while (to := self.step(state, word)) < 0 and state:
                state = link[state]
                matched = length[state]
            if to < 0:
                matched = 0
                continue
            state, matched = to, matched + 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                if self.owner[state] < doc:
                    yield i - window + 1


def picked(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window the start of its picked run, and the hash at each run start.

    The picked run has the smallest hash in the window, the first one of equals.
    """
    runs = tx.gram_hashes(words, PICKED)
    n, wide = len(words) - window + 1, window - PICKED + 1
    if n <= 0:
        return np.zeros(0, np.int64), runs
    # minima of all stretches of `wide` hashes by doubling; earlier positions win ties
    best, size = np.arange(len(runs)), 1
    while size * 2 <= wide:
        left, right = best[:-size], best[size:]
        best, size = np.where(runs[right] < runs[left], right, left), size * 2
    left, right = best[:n], best[wide - size : wide - size + n]
    return np.where(runs[right] < runs[left], right, left), runs


def _docs(batch: pa.RecordBatch, raw: list[bytes]):
    for a, z in tx.slices(batch):
        words, offsets, starts, ends = tx.word_hashes(raw[a:z])
        for i in range(z - a):
            part = slice(offsets[i], offsets[i + 1])
            yield a + i, words[part], starts[part], ends[part]


def _table(names, kinds, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(columns, kinds, strict=True)], names)


def _picks(docs: DataFrame, window: int) -> DataFrame:
    """(row_key, digest, run) for the picked runs of every document, each once."""

    def run(batches):
        for batch in batches:
            raw, digests, keys = tx.as_bytes(batch.column("text")), batch.column("digest").to_pylist(), batch.column("row_key").to_pylist()
            cols = [[], [], []]
            for i, words, _, _ in _docs(batch, raw):
                at, runs = picked(words, window)
                own = np.unique(runs[np.unique(at)]) if len(at) else np.zeros(0, np.uint64)
                short = int.from_bytes(digests[i][:8], "little", signed=True)
                for c, v in zip(cols, (np.full(len(own), keys[i]), np.full(len(own), short), tx.signed(own)), strict=True):
                    c.append(v)
            yield _table(["row_key", "digest", "run"], [pa.int64()] * 3, cols)

    return docs.select("row_key", "digest", "text").mapInArrow(run, "row_key long, digest long, run long")


def _stretches(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """First window and the one after the last of the stretches with one picked run."""
    cut = np.flatnonzero(np.diff(at)) + 1
    ends = [*cut.tolist(), len(at)]
    return zip([0, *cut.tolist()], ends, strict=True) if len(at) else iter(())


def _places(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, row_key, run, start, n, piece) of the stretches of windows whose picked run is in `runs`.

    start is the number of the first word, n the number of windows, piece the digest of the bytes.
    """

    def run(batches):
        names = ["doc_id", "row_key", "run", "start", "n", "piece"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            raw, ids, keys, wanted = (tx.as_bytes(batch.column("text")), batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist(), batch.column("runs"))
            rows = []
            for i, words, starts, ends in _docs(batch, raw):
                at, runs = picked(words, window)
                good = np.isin(tx.signed(runs[at]), wanted[i].values.to_numpy())
                for a, z in _stretches(at):
                    if good[a]:
                        piece = hashlib.blake2b(raw[i][starts[a] : ends[z + window - 2]], digest_size=16).digest()
                        rows.append((ids[i], keys[i], int(tx.signed(runs[at[a]])), a, z - a, piece))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names)

    return docs.mapInArrow(run, "doc_id long, row_key long, run long, start long, n long, piece binary")


def _segments(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, row_key, run, start, text, h) of the stretches that begin at `begins`.

    h holds the window hashes. A run and a window hash together name a window by 128 bits.
    """

    def run(batches):
        names = ["doc_id", "row_key", "run", "start", "text", "h"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        for batch in batches:
            raw, ids, keys, begins = (tx.as_bytes(batch.column("text")), batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist(), batch.column("begins"))
            rows, held = [], 0
            for i, words, starts, ends in _docs(batch, raw):
                at, runs = picked(words, window)
                h, wanted = tx.signed(tx.gram_hashes(words, window)), set(begins[i].as_py())
                for a, z in _stretches(at):
                    if a in wanted:
                        piece = raw[i][starts[a] : ends[z + window - 2]]
                        rows.append((ids[i], keys[i], int(tx.signed(runs[at[a]])), a, piece, h[a:z]))
                        held += len(piece)
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names)

    return docs.mapInArrow(run, "doc_id long, row_key long, run long, start long, text binary, h array<long>")


def _smallest(rows: DataFrame, by: str) -> DataFrame:
    """The rows with `low`, the smallest doc_id among the rows with the same value of the column `by`.

    Values of a thousandth of all rows or more are at most a thousand, and these are broadcast; no other
    value can fill a task. `rows` is read several times and should be a table.
    """
    total = rows.count()
    groups = rows.groupBy(by).agg(F.min("doc_id").alias("low"), F.count("*").alias("_n"))
    groups = tx.materialized(groups, "smallest")
    hot = F.col("_n") * 1000 >= total
    often, seldom = F.broadcast(groups.where(hot).drop("_n")), groups.where(~hot).drop("_n")
    rest = rows.join(F.broadcast(groups.where(hot).select(by)), by, "left_anti").join(seldom, by)
    return rows.join(often, by).unionByName(rest)


def _ranges(starts: np.ndarray) -> np.ndarray:
    """Ascending numbers as first, last, first, last, ... of their unbroken ranges."""
    gap = np.flatnonzero(np.diff(starts) > 1)
    return np.stack([starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)]], 1).ravel()


def _stream(rows: DataFrame, window: int) -> DataFrame:
    """(row_key, ranges) of removable windows; a shard's reference rows come before its streams."""

    def run(batches):
        shard, automaton, ready = None, None, False
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in ("shard", "salt", "kind", "doc_id", "row_key", "start", "text")]
            keys, found = [], []
            for number, salt, kind, doc, key, start, text in zip(*cols, strict=True):
                if (number, salt) != shard:
                    shard, automaton, ready = (number, salt), Automaton(), False
                if kind == 0:
                    automaton.add(text.split(), doc)
                    continue
                if not ready:
                    automaton.finish()
                    ready = True
                hits = list(automaton.covered(text.split(), window, doc))
                if hits:
                    keys.append(key)
                    found.append(_ranges(np.array(hits, np.int64) + start))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["row_key", "ranges"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    return dealt.mapInArrow(run, "row_key long, ranges array<long>")


def _digests(docs: DataFrame, window: int, with_text: bool) -> DataFrame:
    """Per row the counts and the digest of the kept words, and the kept text if asked for."""

    def run(batches):
        for batch in batches:
            raw, keys = tx.as_bytes(batch.column("text")), batch.column("row_key").to_pylist()
            ranges = batch.column("ranges").to_pylist() if "ranges" in batch.schema.names else [None] * len(raw)
            out = []
            for text, hits in zip(raw, ranges, strict=True):
                words = text.split()
                if hits:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, hits[::2], 1)
                    np.add.at(edge, np.array(hits[1::2]) + window, -1)
                    kept = [w for w, c in zip(words, np.cumsum(edge), strict=False) if c == 0]
                else:
                    kept = words
                joined = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode() if with_text else None))
            arrays = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, [pa.int64(), pa.int64(), pa.string(), pa.string()], strict=True)]
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.int64()), *arrays], ["doc_id", "row_key", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return docs.mapInArrow(run, "doc_id long, row_key long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def remove_repeats(docs: DataFrame, window: int = 50, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) for every row of docs (doc_id, text).

    A word goes if a window of `window` consecutive words covers it whose words also start in a document
    with a smaller doc_id. kept_text is filled if with_text. A null text has no words. Rows with a null
    doc_id, and windows that stand only in rows of one doc_id, lose nothing and take nothing from
    others. Repeated rows stay. Other columns are ignored.
    """
    if window <= PICKED:
        raise ValueError(f"window must be above {PICKED}")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    named = docs.where("doc_id is not null and text is not null").withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = _smallest(tx.materialized(named.select("digest", "doc_id", "row_key"), "texts"), "digest")
    texts = tx.materialized(texts.select("row_key", (F.col("low") < F.col("doc_id")).alias("copy")).distinct(), "copies")
    copies, firsts = texts.where("copy").select("row_key", F.lit(True).alias("copy")), texts.where("not copy").select("row_key")

    picks = tx.materialized(_picks(named, window), "picks")
    shared = picks.groupBy("run").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low < high").select("run")
    shared = tx.materialized(shared, "shared_runs")
    wanted = picks.join(firsts, "row_key", "left_semi").join(shared, "run").groupBy("row_key").agg(F.collect_set("run").alias("runs"))
    rows = named.join(wanted, "row_key").dropDuplicates(["row_key"])
    candidates = tx.materialized(rows.select("doc_id", "row_key", "text", "runs"), "candidates")
    places = _smallest(tx.materialized(_places(candidates, window), "places"), "piece")
    places = tx.materialized(places.select("row_key", "start", "n", (F.col("low") < F.col("doc_id")).alias("copy")), "judged")
    begins = places.where("not copy").groupBy("row_key").agg(F.collect_set("start").alias("begins"))
    segments = tx.materialized(_segments(candidates.drop("runs").join(begins, "row_key"), window), "segments")

    windows = segments.select("run", "doc_id", F.explode("h").alias("h"))
    owners = windows.groupBy("run", "h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    owned = tx.materialized(owners.select("run", "h", F.col("low").alias("doc_id")), "owners")
    held = segments.select("run", "doc_id", "row_key", "start", F.posexplode("h").alias("at", "h")).join(owned, ["run", "h", "doc_id"])
    spans = held.groupBy("row_key", "start").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    reference = segments.select("doc_id", "row_key", "run", "start", "text").join(spans, ["row_key", "start"])
    words = F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+")
    cut = F.array_join(F.slice(words, F.col("first") + 1, F.col("last") - F.col("first") + window), " ").cast("binary")
    reference = tx.materialized(reference.select("run", "doc_id", cut.alias("text")).distinct(), "reference")
    size = reference.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, int(size / 6 / SHARD_WORDS) + 1)

    shard = F.pmod(F.xxhash64("run"), F.lit(shards)).cast("int")
    parts = segments.select(shard.alias("shard"), "doc_id", "row_key", "start", "text")
    load = parts.groupBy("shard").agg(F.ceil(F.sum(F.length("text")) / 6 / STREAM_WORDS).cast("int").alias("salts"))
    heads = reference.select(shard.alias("shard"), "doc_id", "text").join(load, "shard")
    heads = heads.select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), "doc_id", F.lit(0).cast("long").alias("row_key"), F.lit(0).cast("long").alias("start"), "text")
    streams = parts.join(load, "shard").select("shard", F.pmod(F.xxhash64("row_key", "start"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind"), "doc_id", "row_key", "start", "text")
    copied = places.where("copy").select("row_key", F.array("start", F.col("start") + F.col("n") - 1).alias("ranges"))
    hits = copied.union(_stream(heads.union(streams), window)).groupBy("row_key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))

    changed = tx.materialized(_digests(candidates.join(hits, "row_key").select("doc_id", "row_key", "text", "ranges"), window, with_text), "changed")
    plain = _digests(docs.select("doc_id", "row_key", "text"), window, with_text)
    new = changed.select("row_key", *(F.col(c).alias(f"new_{c}") for c in ("n_removed", "kept_sha256", "kept_text")))
    both = plain.join(new, "row_key", "left").join(copies, "row_key", "left")
    gone = F.coalesce("copy", F.lit(False)) & (F.col("n_words") >= window)
    nothing = {"n_removed": F.col("n_words"), "kept_sha256": F.sha2(F.lit(""), 256), "kept_text": F.lit("") if with_text else F.lit(None).cast("string")}
    pick = lambda c: F.when(gone, nothing[c]).when(F.col("new_n_removed").isNotNull(), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
    return both.select("doc_id", "n_words", pick("n_removed"), pick("kept_sha256"), pick("kept_text"))
