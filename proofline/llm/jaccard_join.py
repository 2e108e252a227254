"""Exact Jaccard similarity join of documents on word shingles, as a join in a metric space.

Jaccard distance is a metric. Single shingles are the first pivots: the distance of a set x to the
pivot {s} is 1 - 1/|x| if x holds s, else 1, so the regions nearest to x are those of its own shingles.
Sets that can lie within the allowed distance share a region among their first |x| - ceil(t |x|) + 1
shingles in any fixed order, so a set is replicated to these boundary regions and to no others. The
order puts shingles last that are frequent in some stretch of the corpus, which keeps regions small.
Inside a region, neighbours in size whose ratio is below t cannot link and alone ones leave at once.

What is left joins region by region, exactly. Sets first meet as short profiles, their counts by ranges
of hashes: two sets share no more than the sum of the smaller counts, so most sets leave without their
shingles having moved. One pass then compares every set with one pivot set of its nearest region;
sets within reach are one component and need no comparison among themselves. Regions whose members
are still in several components join again: each set in turn is a pivot, its distances are computed
only to sets that the size window and the triangle inequality over earlier pivots leave open, and no
pair is written that is not a link.

No task takes a large region whole. It is cut into overlapping ranges of size, and only the members of a
range that is large itself stay without a look at their profiles. If a large region is still in several
components after the pass, all its members meet its own pivot, salted; then blocks of members meet in
pairs, except blocks of the region's largest component among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx
from proofline.llm.components import components

STRETCH = 1 << 21
OFTEN = 3
HEAVY = 1 << 18
STAR_ROWS = 32
REGION_ROWS = 2000
BLOCK_ROWS = 256


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct hashes of the k-word runs; with fewer words, of the whole run."""
    return np.unique(tx.gram_hashes(words, min(k, len(words)))) if len(words) else np.zeros(0, np.uint64)


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    one = int(tx.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    two = int(tx.mix(shingles ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
    return tuple(x - (1 << 64) if x >> 63 else x for x in (one, two))


def needed(n: int, num: int, den: int) -> int:
    """The smallest overlap a set of n shingles can link with."""
    return -(-num * n // den)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    raw = tx.as_bytes(batch.column("text"))
    for a, z in tx.slices(batch):
        words, offsets, _, _ = tx.word_hashes(raw[a:z], fold=True)
        for i in range(z - a):
            yield a + i, shingle_set(words[offsets[i] : offsets[i + 1]], k)


def frequent(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted shingles that are frequent, and a level for each that rises with the number of documents.

    Every document is counted: each stretch of about STRETCH shingles reports those in OFTEN of its
    documents or more, whatever the size of the corpus, and the HEAVY most frequent ones reach the driver.
    Only the order of the shingles hangs on it, not the result.
    """

    def report(held):
        found, n = np.unique(np.concatenate(held), return_counts=True)
        often = np.flatnonzero(n >= OFTEN)
        often = often[np.argsort(-n[often], kind="stable")[:HEAVY]]
        return pa.RecordBatch.from_arrays([pa.array(tx.signed(found[often])), pa.array(n[often].astype(np.int64))], ["s", "n"])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for _, s in _sets(batch, k):
                held.append(s)
                size += len(s)
                if size >= STRETCH:
                    yield report(held)
                    held, size = [], 0
        if held:
            yield report(held)

    summed = docs.select("text").mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    found = summed.orderBy(F.col("n").desc(), "s").limit(HEAVY).toPandas()
    shingles = found["s"].to_numpy(np.int64).view(np.uint64)
    levels = 1 + np.log2(found["n"].to_numpy(np.float64)).astype(np.uint8) if len(found) else np.zeros(0, np.uint8)
    order = np.argsort(shingles)
    return shingles[order], levels[order]


def levels_of(shingles: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 for each shingle that is not frequent, else its level."""
    out = np.zeros(len(shingles), np.uint8)
    if len(known[0]):
        at = np.minimum(np.searchsorted(known[0], shingles), len(known[0]) - 1)
        same = known[0][at] == shingles
        out[same] = known[1][at[same]]
    return out


def profile(shingles: np.ndarray) -> bytes:
    """Counts of the shingles by ranges of hashes, one byte each, for about four shingles a range."""
    bits = max(2, int(len(shingles) // 4).bit_length())
    return np.minimum(np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def folded(counts: np.ndarray, size: int) -> np.ndarray:
    """A profile in `size` ranges; full counters stand for any number."""
    wide = counts.astype(np.int64)
    wide[counts == 255] = 1 << 30
    return np.minimum(wide.reshape(size, -1).sum(1), 1 << 30)


def has_partner(sizes: np.ndarray, profiles: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which sets (by rising size) have another one that size and profile do not rule out."""
    good, last = np.zeros(len(sizes), bool), np.searchsorted(sizes, sizes * den // num, "right")
    lengths = np.array([len(p) for p in profiles])
    tables: dict[int, np.ndarray] = {}
    filled: dict[int, int] = {}
    for i in range(len(sizes)):
        if last[i] <= i + 1 or good[i : last[i]].all():
            continue
        span = int(lengths[i : last[i]].min())
        if span not in tables:
            tables[span], filled[span] = np.zeros((len(sizes), span), np.int32), 0
        table = tables[span]
        for j in range(max(i, filled[span]), last[i]):
            table[j] = folded(profiles[j], span)
        filled[span] = max(filled[span], last[i])
        # near sizes first: most sets with a partner are done by them
        for a, z in ((i + 1, min(i + 9, last[i])), (i + 9, last[i])):
            if a < z and not (good[i] and good[a:z].all()):
                shared = np.minimum(table[a:z], table[i]).sum(1, dtype=np.int64)
                open_ = den * shared >= num * (sizes[a:z] + sizes[i] - shared)
                good[a:z] |= open_
                good[i] |= open_.any()
    return good


def _prefixes(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Per document: doc_id, the key of its set, its size, and the shingles of its boundary regions."""
    known = docs.sparkSession.sparkContext.broadcast(frequent(docs, k))

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for a, z in tx.slices(batch):
                part, keys, sizes, prefixes, profiles = batch.slice(a, z - a), [], [], [], []
                for _, s in _sets(part, k):
                    keys.append(set_key(s))
                    sizes.append(len(s))
                    profiles.append(profile(s))
                    order = np.argsort(levels_of(s, known.value), kind="stable")
                    prefixes.append(tx.signed(s[order[: len(s) - needed(len(s), num, den) + 1]]) if len(s) else np.zeros(0, np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefixes)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, z - a), pa.array([x for x, _ in keys], pa.int64()), pa.array([y for _, y in keys], pa.int64()), pa.array(sizes, pa.int64()), lists, pa.array(profiles, pa.binary())],
                    ["doc_id", "k1", "k2", "size", "prefix", "profile"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, k1 long, k2 long, size long, prefix array<long>, profile binary")


def _shared(regions: DataFrame, num: int, den: int) -> DataFrame:
    """Members of regions that hold another set of a size they can link with.

    The rows come sorted by region and size; one row is held back, never a whole region.
    """
    parts = regions.sparkSession.conf.get("spark.sql.shuffle.partitions")
    schema = "s long, size long, k1 long, k2 long, pos int"
    names = ["s", "size", "k1", "k2", "pos"]

    def run(batches):
        held = None
        for batch in batches:
            rows = [batch.column(n).to_numpy() for n in names]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held[0], rows, strict=True)]
            keep = np.zeros(len(rows[0]), bool)
            if held is not None:
                keep[0] = held[1]
            s, size, k1, k2 = rows[:4]
            same = (s[1:] == s[:-1]) & (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])
            near = (s[1:] == s[:-1]) & ~same & (size[:-1] * den >= num * size[1:])
            # copies of a set stand together: the first one decides for all
            keep[1:] |= near
            keep[:-1] |= near
            held = [x[-1:] for x in rows], keep[-1]
            out = np.flatnonzero(keep[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in rows], names)
        if held is not None and held[1]:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names)

    dealt = regions.repartition(int(parts), "s").sortWithinPartitions("s", "size", "k1", "k2")
    return dealt.mapInArrow(run, schema).distinct()


def _open(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(s, k1, k2): members of regions that have a partner there which their profiles do not rule out.

    Regions of more than REGION_ROWS (count n) go by ranges of size that hold every pair of sizes which can
    link; the members of a range that is larger itself all stay, as comparing them would take one task.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("size")
        profiles = [np.frombuffer(x, np.uint8) for x in table.column("profile").to_pylist()]
        return table.select(["s", "k1", "k2"]).filter(pa.array(has_partner(table.column("size").to_numpy(), profiles, num, den)))

    schema = "s long, k1 long, k2 long"
    small = rows.where(F.col("n") <= REGION_ROWS).groupBy("s").applyInArrow(run, schema)
    ranges = _bucketed(rows.where(F.col("n") > REGION_ROWS), num, den)
    ranges = ranges.join(ranges.groupBy("s", "bucket").agg(F.count("*").alias("m")), ["s", "bucket"])
    dealt = ranges.where(F.col("m") <= REGION_ROWS).groupBy("s", "bucket").applyInArrow(run, schema)
    return small.union(dealt).union(ranges.where(F.col("m") > REGION_ROWS).select("s", "k1", "k2")).distinct()


def _bucketed(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Large regions (count n) in overlapping ranges of size that hold every pair of sizes that can link."""
    bucket = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(den / num)) + 1e-9).cast("int")
    parts = F.when(F.col("n") > REGION_ROWS, F.array(bucket, bucket + 1)).otherwise(F.array(F.lit(0)))
    return rows.withColumn("bucket", F.explode(parts))


def _blocked(rows: DataFrame) -> DataFrame:
    """Members (s, bucket, n, component) of large regions in pairs (lo, hi) of blocks, others in one.

    The region's largest component has blocks of its own, which meet the other blocks only; every pair
    of members of different components is in one pair of blocks.
    """
    held = rows.where(F.col("n") > REGION_ROWS).groupBy("s", "bucket", "component").agg(F.count("*").alias("m"))
    main = held.groupBy("s", "bucket").agg(F.max(F.struct("m", "component")).alias("main"), F.sum("m").alias("all"))
    rows = rows.join(main, ["s", "bucket"], "left")
    rest = F.ceil((F.col("all") - F.col("main.m")) / BLOCK_ROWS).cast("int")
    most = F.ceil(F.col("main.m") / BLOCK_ROWS).cast("int")
    rows = rows.withColumns({"rest": rest, "most": most, "of_main": F.col("component") == F.col("main.component"), "salt": F.xxhash64("k1", "k2")})
    block = F.when(F.col("of_main"), F.col("rest") + F.pmod("salt", "most")).otherwise(F.pmod("salt", "rest")).cast("int")
    last = F.when(F.col("of_main"), F.col("rest") - 1).otherwise(F.col("rest") + F.col("most") - 1)
    # one component in all of the bucket has nothing to join
    others = F.when(F.col("all").isNull(), F.array(F.lit(0))).when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("block", F.coalesce(block, F.lit(0))).withColumn("other", F.explode(others))
    return rows.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})


def _distinct_regions(rows: DataFrame, *more) -> DataFrame:
    """(s, n) of one region for each different list of members."""
    cells = rows.groupBy("s").agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(k1, k2))").alias("f1"), F.expr("bit_xor(xxhash64(k2, k1, 1))").alias("f2"), *more)
    if more:
        cells = cells.where("low <> high")
    return cells.groupBy("n", "f1", "f2").agg(F.min("s").alias("s")).select("s", "n")


def _fetch(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(k1, k2, size, items) for the wanted sets (k1, k2, doc_id), built again from the texts."""

    def run(batches):
        for batch in batches:
            w1, w2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            for a, z in tx.slices(batch):
                rows = []
                for i, s in _sets(batch.slice(a, z - a), k):
                    if set_key(s) == (w1[a + i], w2[a + i]):
                        rows.append((w1[a + i], w2[a + i], len(s), s.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, [pa.int64(), pa.int64(), pa.int64(), pa.binary()], strict=True)], ["k1", "k2", "size", "items"])

    joined = docs.select("doc_id", "text").join(wanted, "doc_id").select("k1", "k2", "text")
    return joined.mapInArrow(run, "k1 long, k2 long, size long, items binary").dropDuplicates(["k1", "k2"])


def overlaps(many: list[np.ndarray], one: np.ndarray) -> np.ndarray:
    """The number of items of each sorted set that the sorted set `one` has too."""
    joined = np.concatenate(many)
    at = np.minimum(np.searchsorted(one, joined), len(one) - 1)
    return np.add.reduceat((one[at] == joined).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in many])[:-1]]))


def _links(shared: int, x: int, y: int, num: int, den: int) -> bool:
    return den * shared >= num * (x + y - shared)


def _stars(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) of members with the pivot set of their group; the pivot comes first in its group."""

    def run(batches):
        group, pivot = None, None
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in ("s", "salt", "kind", "node", "items")]
            a, b = [], []
            for s, salt, kind, node, items in zip(*cols, strict=True):
                mine = np.frombuffer(items, np.uint64)
                if kind == 0:
                    group, pivot = (s, salt), (node, mine)
                elif group == (s, salt) and node != pivot[0] and _links(int(overlaps([mine], pivot[1])[0]), len(mine), len(pivot[1]), num, den):
                    a.append(node)
                    b.append(pivot[0])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "s", "salt").sortWithinPartitions("s", "salt", "kind").mapInArrow(run, "a long, b long")


def join_region(nodes: list[int], groups: list[int], sets: list[np.ndarray], num: int, den: int, blocks: list[int] | None = None) -> list[tuple[int, int]]:
    """Links between members of different groups that connect all that can be connected.

    Members go by size. Every member is a pivot once; its distances reach only later members of another
    group inside the size window whose distances to all earlier pivots differ by no more than allowed.
    With blocks, members meet those of the other block only, if there are two.
    """
    order = sorted(range(len(nodes)), key=lambda i: (len(sets[i]), nodes[i]))
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    label = np.array([groups[i] for i in order], np.int64)
    side = np.array([blocks[i] for i in order]) if blocks and len(set(blocks)) > 1 else None
    reach = 1 - num / den + 1e-9
    known: list[np.ndarray] = []
    found = []
    for at, i in enumerate(order):
        last = int(np.searchsorted(sizes, sizes[at] * den // num, "right"))
        later = np.arange(at + 1, last)
        later = later[label[later] != label[at]]
        if side is not None:
            later = later[side[later] != side[at]]
        for d in known:
            if len(later):
                gap = np.abs(d[later] - d[at])
                later = later[~(gap > reach)]  # unknown distances are NaN and stay
        if not len(later):
            continue
        shared = overlaps([sets[order[j]] for j in later], sets[i])
        distance = np.full(len(order), np.nan)
        distance[at] = 0
        distance[later] = 1 - shared / (sizes[at] + sizes[later] - shared)
        known = [*known[-7:], distance]
        for j, n in zip(later, shared, strict=True):
            if label[j] != label[at] and _links(int(n), int(sizes[at]), int(sizes[j]), num, den):
                found.append((nodes[order[j]], nodes[i]))
                label[label == label[j]] = label[at]
    return found


def _regions(rows: DataFrame, num: int, den: int) -> DataFrame:
    def run(keys, frame):
        sets = [np.frombuffer(x, np.uint64) for x in frame.column("items").to_pylist()]
        found = join_region(frame.column("node").to_pylist(), frame.column("component").to_pylist(), sets, num, den, frame.column("block").to_pylist())
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return rows.groupBy("s", "bucket", "lo", "hi").applyInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text).

    Two documents link when den * intersection >= num * union of their sets of distinct shingles.
    component_id is the smallest doc_id reachable. Null and empty texts and texts without words have no
    shingles and link with nothing; rows whose doc_id is null link with nothing and get a null
    component_id. Repeated rows stay; rows that share a doc_id count as one document in the graph.
    Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = tx.materialized(_prefixes(docs, shingle, num, den), "prefixes")
    named = base.where("doc_id is not null and size > 0")
    nodes = tx.materialized(named.groupBy("k1", "k2").agg(F.min("doc_id").alias("node")), "nodes")
    rows = named.select("size", "k1", "k2", F.posexplode("prefix").alias("pos", "s"))
    shared = tx.materialized(_shared(rows, num, den).join(nodes.select("k1", "k2", "node"), ["k1", "k2"]), "regions")
    shared = shared.join(_distinct_regions(shared), "s")
    profiles = base.where("doc_id is not null").join(nodes.select("k1", "k2", F.col("node").alias("doc_id")), ["k1", "k2", "doc_id"]).select("k1", "k2", "profile").dropDuplicates(["k1", "k2"])
    near = _open(shared.join(profiles, ["k1", "k2"]), num, den)
    shared = tx.materialized(shared.drop("n").join(near, ["s", "k1", "k2"]), "open_regions")
    wanted = shared.select("k1", "k2", F.col("node").alias("doc_id")).distinct()
    sets = tx.materialized(_fetch(docs, wanted, shingle), "sets")

    # one pass: every set against the pivot set of the nearest region it shares
    nearest = shared.groupBy("k1", "k2").agg(F.min(F.struct("pos", "s")).alias("m"), F.first("node").alias("node")).select("k1", "k2", "node", "m.s")
    pivots = shared.groupBy("s").agg(F.min(F.struct("node", "k1", "k2")).alias("p")).select("s", "p.*")

    def starred(members):
        counts = members.groupBy("s").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("salts"))
        heads = pivots.join(counts, "s").select("s", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), "node", "k1", "k2")
        salted = members.join(counts, "s").select("s", F.pmod(F.xxhash64("k1", "k2"), "salts").cast("int").alias("salt"), F.lit(1).alias("kind"), "node", "k1", "k2")
        rows = heads.union(salted).join(sets.select("k1", "k2", "items"), ["k1", "k2"]).select("s", "salt", "kind", "node", "items")
        return tx.materialized(_stars(rows, num, den), "star_links")

    def unfinished(links):
        """Labelled members, and the regions (s, n) that hold several components."""
        labels = tx.materialized(components(links), "labels")
        labelled = shared.join(labels, "node", "left").select("s", "k1", "k2", "node", "size", F.coalesce("component", "node").alias("component"))
        return labelled, tx.materialized(_distinct_regions(labelled, F.min("component").alias("low"), F.max("component").alias("high")), "unfinished")

    links = starred(nearest)
    labelled, open_cells = unfinished(links)
    large = open_cells.where(F.col("n") > REGION_ROWS).select("s")
    if large.limit(1).count():
        links = links.union(starred(shared.join(large, "s").select("k1", "k2", "node", "s")))
        labelled, open_cells = unfinished(links)
    left = _blocked(_bucketed(labelled.join(open_cells, "s"), num, den)).select("s", "k1", "k2", "node", "component", "bucket", "lo", "hi", "block")
    more = _regions(left.join(sets.select("k1", "k2", "items"), ["k1", "k2"]).select("s", "bucket", "lo", "hi", "block", "node", "component", "items"), num, den)
    # a doc_id with several sets joins the copies of each of them
    ends = base.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("k1", "k2")).alias("low"), F.max(F.struct("k1", "k2")).alias("high"))
    several = named.join(ends.where("low <> high").select("doc_id"), "doc_id").select("doc_id", "k1", "k2").distinct()
    bridges = several.join(nodes, ["k1", "k2"]).where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    more = tx.materialized(more.union(links).union(bridges), "links")
    final = tx.materialized(components(more), "components")

    own = base.join(nodes, ["k1", "k2"], "left").withColumn("node", F.coalesce("node", "doc_id")).join(final, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    return own.select("doc_id", F.col("size").alias("n_shingles"), component.cast("long").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of every group of linked texts the row with the smallest doc_id; rows without a doc_id stay.

    Rows that share a doc_id are judged by their own texts, so none goes for what another one holds. Of
    rows with the same doc_id and text the one with the smallest other columns stays; columns that have no
    order are allowed only if no such rows differ in them. Null and empty texts link with nothing. Columns
    stay, whatever their names. A text goes through the join by a 64-bit name; a second one keeps rows
    whose first names agree by chance apart.
    """
    key, other, row = tx.free(docs.columns, "_key", "_other", "_row")
    names = {key: F.xxhash64("doc_id", "text"), other: F.xxhash64(F.lit(10), "text", "doc_id")}
    keyed = docs.where("doc_id is not null").withColumns(names)
    found = jaccard_components(keyed.select(F.col(key).alias("doc_id"), "text"))
    owner = keyed.select(key, "doc_id").join(found.select(F.col("doc_id").alias(key), "component_id").distinct(), key)
    kept = owner.groupBy("component_id").agg(F.min(F.struct("doc_id", key)).alias("first")).select(F.col("first")[key].alias(key))
    one = keyed.join(kept, key, "left_semi").groupBy(key, other).agg(F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias(row))
    return one.select(*(F.col(row)[c].alias(c) for c in docs.columns)).union(docs.where("doc_id is null"))
