"""Copies compared by trees of digests over ranges of key hashes, and by sampled row hashes.

The hash of a key, whatever its type, places its row in one of FANOUT ** LEVELS ranges. A
range's digest is the count of its rows and two order-free sums of row hashes; a range of a
higher level sums its FANOUT children. A tree is written once for each copy, so that two
copies, and the same copies later, compare by reading a few digests from the top: only the
children of ranges that differ are read, and only their rows move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.contract import Table
from proofline.operators.compare import canonical, row_diff

BITS = 4  # of the key hash by level: 16 children
LEVELS = 5
MOST_RANGES = 1 << 14  # that the driver holds and broadcasts; beyond, the level above decides
TREE = "node long, rows long, one decimal(38,0), two decimal(38,0), level int"


def key_range(table: Table, level: int, bits: int = BITS) -> Column:
    """The number of a row's range at a level; a NULL key has its own hash."""
    return F.shiftrightunsigned(F.xxhash64(canonical(table, table.key).cast("string")), 64 - bits * level)


def tree(df: DataFrame, table: Table, levels: int = LEVELS, bits: int = BITS) -> DataFrame:
    """(node, rows, one, two, level) of every range that has rows, from one scan.

    Rows fold into the ranges of the last level before they move; the levels above are sums
    of these. The hash of a row skips NULLs, so their places are hashed too.
    """
    if not 0 < levels * bits < 63:
        raise ValueError("the levels need between 1 and 62 bits of the key hash")
    columns = [canonical(table, n) for n in table.names()] + [F.col(n).isNull() for n in table.names()]
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (1, 2)]
    leaves = df.groupBy(key_range(table, levels, bits).alias("leaf")).agg(F.count(F.lit(1)).alias("n"), *[c.alias(f"s{i}") for i, c in enumerate(sums)])
    each = leaves.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(levels))))
    node = F.expr(f"shiftrightunsigned(leaf, {bits} * ({levels} - level))")
    return each.groupBy(node.alias("node"), "level").agg(
        F.sum("n").alias("rows"), *[F.sum(f"s{i}").cast("decimal(38,0)").alias(n) for i, n in enumerate(("one", "two"))]
    ).select("node", "rows", "one", "two", "level")


def write_tree(digests: DataFrame, path: str) -> None:
    """One folder for each level, ranges in order, so that a few of them are read without the others."""
    digests.repartition("level").sortWithinPartitions("level", "node").write.partitionBy("level").parquet(path)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TREE).parquet(path)


def _differing(source: DataFrame, target: DataFrame, level: int, parents: list[int] | None, bits: int) -> DataFrame:
    """(node, source_rows, target_rows) of the ranges of a level that differ, below the given parents."""
    spark = source.sparkSession

    def part(df: DataFrame, name: str) -> DataFrame:
        found = df.where(F.col("level") == level)
        if parents is not None:
            wanted = spark.createDataFrame([(p,) for p in parents], "parent long")
            span = found.where(F.col("node").between(min(parents) << bits, ((max(parents) + 1) << bits) - 1))
            found = span.join(F.broadcast(wanted), F.shiftrightunsigned("node", bits) == F.col("parent"), "left_semi")
        return found.select("node", F.col("rows").alias(f"{name}_rows"), F.col("one").alias(f"{name}_one"), F.col("two").alias(f"{name}_two"))

    both = part(source, "source").join(part(target, "target"), "node", "full_outer")
    same = [F.col(f"source_{c}").eqNullSafe(F.col(f"target_{c}")) for c in ("rows", "one", "two")]
    return both.where(~(same[0] & same[1] & same[2])).select("node", "source_rows", "target_rows")


def differing_ranges(source: DataFrame, target: DataFrame, levels: int = LEVELS, bits: int = BITS, most: int = MOST_RANGES) -> tuple[int, list[int]]:
    """The deepest level reached and its ranges that differ between two trees, none for equal copies.

    Each step reads only the children of the ranges found before it. It ends at the last level,
    or where more than ``most`` ranges differ: the ranges of the level above stand then.
    """
    level, found = 0, [0]
    while level < levels and found:
        below = _differing(source, target, level + 1, found if level else None, bits)
        next_ = [r.node for r in below.select("node").orderBy("node").limit(most + 1).collect()]
        if len(next_) > most:
            break
        level, found = level + 1, next_
    return level, found


def hash_tree_diff(
    source: DataFrame, target: DataFrame, table: Table, source_tree: DataFrame, target_tree: DataFrame, levels: int = LEVELS, bits: int = BITS, most: int = MOST_RANGES
) -> DataFrame:
    """The row compare of only the rows in ranges whose digests differ, for keys of any type.

    The trees are those of the two frames, written or not. Equal copies give no rows and move none.
    """
    level, ranges = differing_ranges(source_tree, target_tree, levels, bits, most)
    if not level:  # more than `most` ranges differ already at the first level
        return row_diff(source, target, table)
    wanted = F.broadcast(source.sparkSession.createDataFrame([(r,) for r in ranges], "_range long"))

    def inside(df: DataFrame) -> DataFrame:
        return df.join(wanted, key_range(table, level, bits) == F.col("_range"), "left_semi")

    return row_diff(inside(source), inside(target), table)


def row_digest(table: Table) -> Column:
    """A digest of a whole row that any engine can compute: lengths and texts of its canonical values."""

    def piece(name: str) -> Column:
        text = canonical(table, name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat_ws("|", *[piece(n) for n in table.names()]), 256)


def row_hash_sample(source: DataFrame, target: DataFrame, table: Table, every: int) -> DataFrame:
    """(table_name, row_key, source_hash, target_hash, same) of about one key in ``every``.

    A key is in the sample by its own digest, so both copies sample the same keys, and other
    rows leave at the scan. Rows with a NULL key are not sampled. A repeated key has a row for
    each of its pairs.
    """
    key = canonical(table, table.key).cast("string")

    def side(df: DataFrame, name: str) -> DataFrame:
        chosen = df.where(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % every == 0)
        return chosen.select(key.alias("row_key"), row_digest(table).alias(f"{name}_hash"))

    both = side(source, "source").join(side(target, "target"), "row_key", "full_outer")
    same = F.col("source_hash").eqNullSafe(F.col("target_hash"))
    return both.select(F.lit(table.name).alias("table_name"), "row_key", "source_hash", "target_hash", same.alias("same"))
