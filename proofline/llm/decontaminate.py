"""Benchmark leaks in documents by latent semantic retrieval, then word order and answer checks.

Benchmark items are cut into passages; all passages together are a TF-IDF matrix (term weight
sqrt(tf) * idf, idf over 32-word stretches of all documents), whose randomised SVD, spread over Spark,
gives a latent space of far fewer dimensions than passages. Documents are read as overlapping windows
of words. Windows with enough of their squared length in the benchmark's terms, which prefix sums give
for all windows at once, are projected, and the latent cosine finds candidates, paraphrases among them.
What else stands in a window can keep it out, so there is a second source of candidates that foreign
words cannot change: each place of one of a passage's rarest words, as long as enough of the others
stand around it. A candidate is a leak if the longest common subsequence of words covers enough of the
passage and the passage's rarest words, its answer, stand there too.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proofline.llm import latent
from proofline.llm import text as tx

#: passages of a pass; dealt by hash, so a pass may have a few more
PASS = 2048
PASSAGE_WORDS = 64
WIDTHS = (24, 32, 48, 64)
STRIDE = 8
STRETCH = 32
ANSWER_WORDS = 3
#: shorter passages stand in texts by chance in parts, so they are looked up as they are
ANCHORED_WORDS = 8
#: passages that are shorter still leak only as a whole text
VERBATIM_WORDS = 3
ANCHOR_ROWS = 1 << 19


def _passages(items: DataFrame) -> DataFrame:
    """(item_id, part, words): hashes of at most PASSAGE_WORDS lower-cased words, each part once.

    Of a longer item every part has PASSAGE_WORDS words; the last part is its last words.
    """

    def run(batches):
        for batch in batches:
            raw, ids = tx.as_bytes(pa.compute.utf8_lower(batch.column("text"))), batch.column("item_id").to_pylist()
            out = []
            for a, z in tx.slices(batch):
                words, offsets, _, _ = tx.word_hashes(raw[a:z])
                for i in range(z - a):
                    own = tx.signed(words[offsets[i] : offsets[i + 1]])
                    last = max(0, len(own) - PASSAGE_WORDS)
                    cuts = [*range(0, last, PASSAGE_WORDS), last]
                    out += [(ids[a + i], n, own[c : c + PASSAGE_WORDS].tolist()) for n, c in enumerate(cuts) if len(own)]
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, kinds, strict=True)], ["item_id", "part", "words"])

    return items.mapInArrow(run, "item_id long, part int, words array<long>")


def _counts(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """(term, n): the number of 32-word stretches of all documents with each term of the passages, null for all stretches."""
    terms = passages.select(F.explode("words").alias("t")).distinct().toPandas()["t"].to_numpy(np.int64).view(np.uint64)
    vocabulary = docs.sparkSession.sparkContext.broadcast(np.sort(terms))

    def run(batches):
        terms = vocabulary.value
        counts, stretches = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            raw = tx.as_bytes(pa.compute.utf8_lower(batch.column("text")))
            for a, z in tx.slices(batch):
                words, offsets, _, _ = tx.word_hashes(raw[a:z])
                n = np.diff(offsets)
                within = np.arange(len(words)) - np.repeat(offsets[:-1], n)
                first = (within % STRETCH == 0).cumsum()
                stretches += int(first[-1]) if len(first) else 0
                at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
                hit = terms[at] == words
                counts += np.bincount(np.unique(first[hit] * len(terms) + at[hit]) % len(terms), minlength=len(terms))
        some = np.flatnonzero(counts)
        names = [*tx.signed(terms[some]).tolist(), None]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(np.append(counts[some], stretches))], ["term", "n"])

    each = docs.select("text").mapInArrow(run, "term long, n long")
    every = passages.select(F.explode("words").alias("term")).distinct().select("term", F.lit(0).cast("long").alias("n"))
    return each.unionAll(every).groupBy("term").agg(F.sum("n").alias("n"))


def weights(words: np.ndarray, terms: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and sqrt(tf) * idf of the known words."""
    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
    own, n = np.unique(at[terms[at] == words], return_counts=True)
    return own, np.sqrt(n) * idf[own]


def _entries(passages: DataFrame, idf: DataFrame) -> DataFrame:
    """(row, term, weight): sqrt(tf) * idf of every passage's terms, of length 1."""
    each = passages.select("row", F.explode("words").alias("term")).groupBy("row", "term").agg(F.count("*").alias("tf"))
    each = each.join(idf, "term").select("row", "term", (F.sqrt("tf") * F.col("idf")).alias("weight"))
    return each.withColumn("weight", F.col("weight") / F.sqrt(F.sum(F.col("weight") ** 2).over(Window.partitionBy("row"))))


def _space(passages: DataFrame, idf: DataFrame, right: DataFrame, turned: DataFrame) -> dict:
    """What a pass needs of its passages: terms, their weights and latent vectors, passages and theirs."""
    own = passages.select(F.explode("words").alias("term")).distinct()
    terms = own.join(idf, "term").join(right, "term").toPandas().sort_values("term", key=lambda t: t.to_numpy(np.int64).view(np.uint64))
    rows = passages.join(turned, "row").orderBy("row").select("item_id", "words", "v").collect()
    latent = np.array([np.frombuffer(r["v"]) for r in rows])
    return {
        "terms": terms["term"].to_numpy(np.int64).view(np.uint64),
        "weight": terms["idf"].to_numpy(np.float64),
        "right": np.array([np.frombuffer(v) for v in terms["v"]]).astype(np.float32),
        "latent": (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)).astype(np.float32),
        "items": [r["item_id"] for r in rows],
        "words": [np.array(r["words"], np.int64).view(np.uint64) for r in rows],
    }


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, a column of bits for each element of b."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for x in b:
        both = state & places.get(x, 0)
        state = ((state + both) | (state - both)) & full
    return len(a) - state.bit_count()


def check(passage: np.ndarray, region: np.ndarray, rare: set, order: float, answer: float) -> tuple[bool, float]:
    """Whether the region holds the passage in order and its rarest words, and the share in order."""
    ours = passage.tolist()
    share = lcs(ours, region.tolist()) / len(ours)
    kept = len(rare & set(region.tolist())) / len(rare)
    return share >= order and kept >= answer, share


def rarest(passage: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> list[int]:
    """The distinct ones of the passage's ANSWER_WORDS rarest words, rarest first."""
    t = np.searchsorted(terms, passage)
    return list(dict.fromkeys(passage[np.lexsort((passage, -weight[t]))][:ANSWER_WORDS].tolist()))


def anchors(space: dict, answer: float) -> dict:
    """The places in passages by which they are looked up, ordered by term, and what a region must hold.

    A region needs `need` of a passage's rarest words, so it holds at least one of the first
    len(rarest) - need + 1 of them; only these are looked up. Passages of under ANCHORED_WORDS words
    must stand as they are, so they need all of them and are looked up by the first one's first place.
    """
    words, terms = space["words"], space["terms"]
    rare, need, found = np.full((len(words), ANSWER_WORDS), -1, np.int64), np.ones(len(words), np.int64), []
    for p, passage in enumerate(words):
        own = rarest(passage, terms, space["weight"])
        rare[p, : len(own)] = np.searchsorted(terms, np.array(own, np.uint64))
        if len(passage) < ANCHORED_WORDS:
            need[p] = len(own)
            found.append((rare[p, 0], p, int(np.argmax(passage == np.uint64(own[0])))))
        else:
            need[p] = next(k for k in range(1, len(own) + 1) if k == len(own) or k / len(own) >= answer)
            found += [(rare[p, i], p, q) for i in range(len(own) - need[p] + 1) for q in np.flatnonzero(passage == np.uint64(own[i]))]
    rows = np.array(sorted(found), np.int64).reshape(-1, 3)
    answers = np.zeros(len(terms), bool)
    answers[rare[rare >= 0]] = True
    first = np.searchsorted(rows[:, 0], np.arange(len(terms) + 1))
    size = np.array([len(w) for w in words], np.int64)
    return {"rare": rare, "need": need, "size": size, "first": first, "passage": rows[:, 1], "place": rows[:, 2], "answers": answers}


def answer_places(at: np.ndarray, hit: np.ndarray, table: dict) -> np.ndarray:
    """term * (words + 1) + place of every word that is one of some passage's rarest, in order."""
    spots = np.flatnonzero(hit & table["answers"][at])
    return np.sort(at[spots] * (len(at) + 1) + spots)


def holds_answer(keys: np.ndarray, n: int, table: dict, passage: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether the words from low to high hold as many of the passages' rarest words as they need."""
    keys, held = np.append(keys, np.iinfo(np.int64).max), np.zeros(len(passage), np.int64)
    for term in table["rare"][passage].T:
        near = keys[np.searchsorted(keys, term * n + low)]
        held += (term >= 0) & (near < term * n + high)
    return held >= table["need"][passage]


def anchored(offsets: np.ndarray, at: np.ndarray, hit: np.ndarray, keys: np.ndarray, table: dict, order: float):
    """(document, passage, start, low, high): places where a passage may start and the region to look at.

    The region reaches half a passage beyond the place on both sides; that of a passage of under
    ANCHORED_WORDS words is its place. It is left out only if it holds too few of the benchmark's words
    for the order or too few of the rarest words for the answer.
    """
    n, known = len(at) + 1, np.concatenate([[0], np.cumsum(hit)])
    spots = np.flatnonzero(hit)
    spots = spots[table["first"][at[spots] + 1] > table["first"][at[spots]]]
    for part in np.split(spots, np.flatnonzero(np.diff(np.cumsum(table["first"][at[spots] + 1] - table["first"][at[spots]]) // ANCHOR_ROWS)) + 1):
        begin, times = table["first"][at[part]], table["first"][at[part] + 1] - table["first"][at[part]]
        row = np.repeat(begin - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum()) if len(part) else begin
        x, passage = np.repeat(part, times), table["passage"][row]
        size = table["size"][passage]
        doc, start = np.searchsorted(offsets, x, "right") - 1, x - table["place"][row]
        short = size < ANCHORED_WORDS
        spare = np.where(short, 0, size // 2)
        low, high = np.maximum(offsets[doc], start - spare), np.minimum(offsets[doc + 1], start + size + spare)
        ok = known[high] - known[low] >= np.where(short, 1, order) * size - 1e-9
        # one or two words are no evidence unless they are the whole text
        ok &= (size >= VERBATIM_WORDS) | (high - low == offsets[doc + 1] - offsets[doc])
        doc, passage, start, low, high = (c[ok] for c in (doc, passage, start, low, high))
        ok = holds_answer(keys, n, table, passage, low, high)
        yield from np.unique(np.stack([doc, passage, start, low, high], 1)[ok], axis=0).tolist()


def latent_scores(rows: np.ndarray, own: np.ndarray, values: np.ndarray, n: int, space: dict) -> np.ndarray:
    """Latent cosines of n sparse windows (row, term, value; sorted by row) with the passages of a space."""
    latent = np.zeros((n, space["right"].shape[1]), np.float32)
    if len(rows):
        first = np.flatnonzero(np.concatenate([[True], np.diff(rows) != 0]))
        latent[rows[first]] = np.add.reduceat(space["right"][own] * values[:, None].astype(np.float32), first, axis=0)
    return (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)) @ space["latent"].T


def _search(docs: DataFrame, shared, unknown: float, cosine: float, order: float, answer: float, close: float, loose: float) -> DataFrame:
    def windows(words, offsets, at, hit, squares):
        """Starts, ends and documents of the windows with enough of their squared length in known terms.

        The last window of a text ends with it; only a whole text can be shorter than the width.
        """
        energy = np.concatenate([[0], np.cumsum(squares)])
        known = np.concatenate([[0], np.cumsum(np.where(hit, squares, 0))])
        within = np.arange(len(words)) - np.repeat(offsets[:-1], np.diff(offsets))
        every = np.flatnonzero(within % STRIDE == 0)
        of = np.searchsorted(offsets, every, "right") - 1
        for width in WIDTHS:
            use = (within[every] == 0) | (every + width < offsets[of + 1] + STRIDE)
            doc = of[use]
            starts = np.maximum(offsets[doc], np.minimum(every[use], offsets[doc + 1] - width))
            ends = np.minimum(starts + width, offsets[doc + 1])
            open_ = np.flatnonzero(known[ends] - known[starts] >= cosine**2 * (energy[ends] - energy[starts]))
            for part in np.array_split(open_, len(open_) // 2048 + 1):
                if len(part):
                    yield starts[part], ends[part], doc[part]

    def run(batches):
        space = shared.value
        terms, weight, passages = space["terms"], space["weight"], space["words"]
        table, rare = anchors(space, answer), {}

        def judged(j, region, least):
            if j not in rare:
                rare[j] = set(rarest(passages[j], terms, weight))
            return check(passages[j], region, rare[j], least, answer)

        def note(best, row, j, cosine, share):
            old = best.get((row, j), (0.0, 0.0))
            best[row, j] = (max(cosine, old[0]), max(share, old[1]))

        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id").to_pylist()
            raw, best = tx.as_bytes(pa.compute.utf8_lower(texts)), {}
            for a, z in tx.slices(batch):
                words, offsets, _, _ = tx.word_hashes(raw[a:z])
                if not len(words):
                    continue
                at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
                hit = terms[at] == words
                squares = np.where(hit, weight[at], unknown) ** 2
                keys = answer_places(at, hit, table)
                for d, j, start, low, high in anchored(offsets, at, hit, keys, table, order):
                    passage = passages[j]
                    good, share = judged(j, words[low:high], order if len(passage) >= ANCHORED_WORDS else 1.0)
                    if good:
                        a_, z_ = max(int(offsets[d]), start), min(int(offsets[d + 1]), start + len(passage))
                        own, values = weights(words[a_:z_], terms, weight)
                        score = latent_scores(np.zeros(len(own), np.int64), own, values, 1, space)[0, j]
                        note(best, a + d, j, float(score), share)
                for starts, ends, doc in windows(words, offsets, at, hit, squares):
                    n = ends - starts
                    place = np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    row = np.repeat(np.arange(len(n)), n)
                    use = hit[place]
                    key, times = np.unique(row[use] * len(terms) + at[place[use]], return_counts=True)
                    row, own = key // len(terms), key % len(terms)
                    scores = latent_scores(row, own, np.sqrt(times) * weight[own], len(n), space)
                    w, j = np.nonzero((scores >= cosine) & (table["size"] >= VERBATIM_WORDS))
                    low = np.maximum(offsets[doc[w]], starts[w] - table["size"][j] // 2)
                    high = np.minimum(offsets[doc[w] + 1], ends[w] + table["size"][j] // 2)
                    kept = np.flatnonzero(holds_answer(keys, len(at) + 1, table, j, low, high))
                    for c in kept.tolist():
                        score = float(scores[w[c], j[c]])
                        paraphrase = score >= close and table["size"][j[c]] >= ANCHORED_WORDS
                        good, share = judged(int(j[c]), words[low[c] : high[c]], loose if paraphrase else order)
                        if good:
                            note(best, a + int(doc[w[c]]), int(j[c]), score, share)
            items: dict = {}
            for (row, j), (score, share) in best.items():
                note(items, row, space["items"][j], score, share)
            cols = [[ids[r] for r, _ in items], [i for _, i in items], [s for s, _ in items.values()], [s for _, s in items.values()], [hashlib.sha256(texts[r].as_py().encode()).digest() for r, _ in items]]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "cosine", "in_order", "text_key"])

    return docs.mapInArrow(run, "doc_id long, item_id long, cosine double, in_order double, text_key binary")


def _merged(found: DataFrame) -> DataFrame:
    """One row for each document row and item from those of several passes (part).

    Equal document rows come equally often from every pass that finds them, so they are counted in each
    and come as often as in the pass that has most.
    """
    name = ["doc_id", "text_key", "item_id"]
    best = [F.max("cosine").alias("cosine"), F.max("in_order").alias("in_order")]
    each = found.groupBy(*name, "part").agg(F.count("*").alias("n"), *best)
    one = each.groupBy(*name).agg(F.max("n").cast("int").alias("n"), *best)
    return one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))


def _leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.5, order: float = 0.8, answer: float = 0.6, rank: int = 64, close: float = 0.8, loose: float = 0.6) -> DataFrame:
    """find_leaks with text_key, the SHA-256 of the document row's text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    spark, columns = docs.sparkSession, ["doc_id", "item_id", "cosine", "in_order", "text_key"]
    passages = tx.materialized(_passages(items).dropDuplicates(["item_id", "words"]), "passages")
    total = passages.count()
    if not total:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, in_order double, text_key binary")
    passages = tx.materialized(passages.withColumn("row", F.monotonically_increasing_id()), "passage_rows")
    passes = -(-total // PASS)
    parts = [passages.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == number) for number in range(passes)]
    parts = [part for part in parts if not part.isEmpty()]
    counted = [tx.materialized(_counts(docs, part), "term_counts") for part in parts]
    counts = reduce(DataFrame.unionAll, counted)
    stretches = counted[0].where("term is null").agg(F.max("n")).first()[0] or 0
    idf = counts.where("term is not null").groupBy("term").agg(F.max("n").alias("n")).select("term", F.log((stretches + 2) / (F.col("n") + 1)).alias("idf"))
    idf = tx.materialized(idf, "idf")
    entries = tx.materialized(_entries(passages, idf), "entries")
    right, turned = latent.decompose(entries, min(rank, -(-total // 2)))
    found = []
    for number, part in enumerate(parts):
        shared = spark.sparkContext.broadcast(_space(part, idf, right, turned))
        unknown = float(np.log(stretches + 2))
        found.append(_search(docs, shared, unknown, cosine, order, answer, close, loose).withColumn("part", F.lit(number)))
    return (_merged(reduce(DataFrame.unionAll, found)) if len(found) > 1 else found[0]).select(columns)


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.5, order: float = 0.8, answer: float = 0.6, rank: int = 64, close: float = 0.8, loose: float = 0.6) -> DataFrame:
    """(doc_id, item_id, cosine, in_order): each document row with each benchmark item it leaks, once.

    docs (doc_id, text), benchmark (item_id, text). cosine (latent) and in_order are the best of the
    places found. A leak needs a common subsequence of at least `order` of the words of one of the item's
    passages and at least `answer` of its three rarest words, in a window whose latent cosine with the
    passage is at least `cosine`, or within half a passage of the place that one of its rarest words gives
    it, whatever the cosine. From a cosine of `close` on, a paraphrase, `loose` replaces `order`. Passages
    of VERBATIM_WORDS to ANCHORED_WORDS - 1 words need all of these rarest words, and outside of windows
    must stand as they are; still shorter ones leak only as a whole text, upper and lower case alike.

    Null and empty texts leak nothing, and items without words are never leaked; a null doc_id or item_id
    is carried along. Repeated document rows are each reported, repeated passages once for each item_id.
    Very long texts are read whole. Other columns are ignored. Passages share one latent space and go through
    in passes of about PASS, each with two scans of the documents, so what is broadcast has a fixed
    bound; a window's cosine sees the terms of its pass only.
    """
    return _leaks(docs, benchmark, cosine, order, answer, rank, close, loose).drop("text_key")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text) that hold no passage of a benchmark item, with all their columns.

    Rows are judged by their own texts, also those that share a doc_id or have none; null and empty texts
    and repeated rows stay, whatever the columns are called.
    """
    (key,) = tx.free(docs.columns, "_key")
    texts = _leaks(docs, benchmark).select(F.lower(F.hex("text_key")).alias(key)).distinct()
    return docs.withColumn(key, F.sha2(F.col("text").cast("string"), 256)).join(texts, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
