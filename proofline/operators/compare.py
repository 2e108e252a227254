"""Two copies of the same data against each other: fingerprints, checksums, rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.contract import Table
from proofline.functions.predicates import whole_blocks

KEY_BLOCK = 10_000  # keys per checksum partition


def fingerprint_diff(source: DataFrame, target: DataFrame, only_differences: bool = True) -> DataFrame:
    """Join two fingerprints on what was measured; a value present on one side only differs."""
    on = ["table_name", "check_name", "subject", "key"]
    one, other = source.select(F.struct(*on).alias("m"), "value"), target.select(F.struct(*on).alias("m"), "value")
    # a NULL key is a group of its own
    both = one.alias("s").join(other.alias("t"), F.col("s.m").eqNullSafe(F.col("t.m")), "full_outer").select(
        F.coalesce("s.m", "t.m").alias("m"), F.col("s.value").alias("source_value"), F.col("t.value").alias("target_value")
    )
    both = both.select("m.*", "source_value", "target_value").withColumn("same", F.col("source_value").eqNullSafe(F.col("target_value")))
    return both.where(~F.col("same")) if only_differences else both


def canonical(table: Table, name: str) -> Column:
    """A column in the form in which two copies must agree."""
    c = F.col(name)
    kind = table.column(name).type
    return F.rtrim(c) if kind == "char" else F.lower(c) if kind == "uuid" else c


def block_checksums(df: DataFrame, table: Table, block: int = KEY_BLOCK) -> DataFrame:
    """Row count and an order-free sum of row hashes for every block of the key space."""
    # the hash skips NULLs, so their places are hashed too
    row_hash = F.xxhash64(
        *[canonical(table, n) for n in table.names()], *[F.col(n).isNull() for n in table.names()]
    )
    return df.groupBy(whole_blocks(F.col(table.key), block).alias("key_block")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_hash.cast("decimal(38,0)")).alias("checksum")
    )


def differing_blocks(source: DataFrame, target: DataFrame, table: Table, block: int = KEY_BLOCK) -> DataFrame:
    """Blocks whose rows are not the same multiset on both sides."""
    s = block_checksums(source, table, block).select("key_block", F.col("rows").alias("source_rows"), F.col("checksum").alias("a"))
    t = block_checksums(target, table, block).select("key_block", F.col("rows").alias("target_rows"), F.col("checksum").alias("b"))
    both = s.join(t, s.key_block.eqNullSafe(t.key_block), "full_outer")
    return both.where(
        ~(F.col("source_rows").eqNullSafe(F.col("target_rows")) & F.col("a").eqNullSafe(F.col("b")))
    ).select(F.coalesce(s.key_block, t.key_block).alias("key_block"), "source_rows", "target_rows")


def _differences(source: DataFrame, target: DataFrame, key: Column, columns: dict[str, Column]) -> DataFrame:
    """One row per key whose rows differ, with the differing values of either side.

    Equal rows cancel out: both sides are stacked and counted per distinct row, so
    one shuffle on whole rows replaces a join, and a repeated key or a repeated row
    costs its distinct forms instead of all pairs. What is left is folded per key.
    """

    def side(df: DataFrame, weight: int) -> DataFrame:
        return df.select(
            key.alias("_key"), *[c.alias(n) for n, c in columns.items()], F.lit(weight).alias("_balance")
        )

    left = (
        side(source, 1)
        .unionByName(side(target, -1))
        .groupBy("_key", *columns)
        .agg(F.sum("_balance").alias("_balance"))
        .where(F.col("_balance") != 0)
    )
    in_source, in_target = F.col("_balance") > 0, F.col("_balance") < 0
    folded = left.groupBy("_key").agg(
        F.sum(F.when(in_source, F.col("_balance")).otherwise(0)).alias("only_source"),
        F.sum(F.when(in_target, -F.col("_balance")).otherwise(0)).alias("only_target"),
        *[F.max(F.when(in_source, F.col(n))).alias(f"s_{n}") for n in columns],
        *[F.max(F.when(in_target, F.col(n))).alias(f"t_{n}") for n in columns],
    )
    status = (
        F.when((F.col("only_source") > 1) | (F.col("only_target") > 1), "repeated_key")
        .when(F.col("only_target") == 0, "missing_in_target")
        .when(F.col("only_source") == 0, "extra_in_target")
        .otherwise("changed")
    )
    return folded.withColumn("status", status)


def row_diff(source: DataFrame, target: DataFrame, table: Table) -> DataFrame:
    """Every key whose rows differ, and in which columns.

    ``status`` is missing_in_target, extra_in_target, changed, or repeated_key where a
    key has several differing rows on a side and no single counterpart exists.
    """
    rest = [n for n in table.names() if n != table.key]
    found = _differences(source, target, canonical(table, table.key), {n: canonical(table, n) for n in rest})
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f"s_{n}").eqNullSafe(F.col(f"t_{n}")), F.lit(n)) for n in rest])
    )
    return found.select(
        F.lit(table.name).alias("table_name"),
        F.col("_key").cast("string").alias("row_key"),
        "status",
        F.when(F.col("status") == "changed", F.array_join(differing, ",")).alias("columns"),
        F.col("only_source").cast("bigint").alias("only_source"),
        F.col("only_target").cast("bigint").alias("only_target"),
    )


def narrowed_row_diff(source: DataFrame, target: DataFrame, table: Table, block: int = KEY_BLOCK) -> DataFrame:
    """Row compare of only those key blocks whose checksums differ.

    Two column scans decide what has to be shuffled; equal copies shuffle nothing but
    block sums.
    """
    suspects = differing_blocks(source, target, table, block).select(F.col("key_block").alias("_block"))

    def suspect(df: DataFrame) -> DataFrame:
        tagged = df.withColumn("_block", whole_blocks(F.col(table.key), block))
        return tagged.join(suspects, tagged["_block"].eqNullSafe(suspects["_block"]), "left_semi").drop("_block")

    return row_diff(suspect(source), suspect(target), table)


def store_bucketed(df: DataFrame, table: Table, name: str, buckets: int) -> DataFrame:
    """A copy as a stored table in ``buckets`` buckets of the canonical key, sorted by it."""
    keyed = df.select(*[canonical(table, n).alias(n) for n in table.names()])
    keyed.repartition(buckets, table.key).write.format("parquet").bucketBy(buckets, table.key).sortBy(table.key).saveAsTable(name)
    return df.sparkSession.table(name)


def bucketed_row_diff(source: DataFrame, target: DataFrame, table: Table) -> DataFrame:
    """The row compare of copies stored in equal buckets of the key: each bucket meets its counterpart where it lies.

    Each side folds to one row per key inside its buckets, so repeated keys meet once and
    the join has at most one row on each side. A key with several rows on a side compares
    the multisets of their digests. NULL keys lie in a bucket but equal nothing, so their rows
    come out as missing and as extra.
    """
    rest = [n for n in table.names() if n != table.key]

    def side(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*[canonical(table, n).alias(n) for n in rest])
        # equal rows may stand in any order, so the digests of a key are summed
        digest = F.xxhash64(*[canonical(table, n) for n in rest], *[F.col(n).isNull() for n in rest]).cast("decimal(38,0)")
        folded = df.groupBy(F.col(table.key)).agg(F.count(F.lit(1)).alias(f"{name}_n"), F.max(row).alias(f"{name}_row"), F.sum(digest).alias(f"{name}_sum"))
        return folded.withColumn(f"{name}_key", F.col(table.key)).withColumnRenamed(table.key, f"_{name}")

    both = side(source, "s").join(side(target, "t"), F.col("_s") == F.col("_t"), "full_outer")
    same = F.col("s_n").eqNullSafe(F.col("t_n")) & F.col("s_row").eqNullSafe(F.col("t_row")) & F.col("s_sum").eqNullSafe(F.col("t_sum"))
    found = both.where(~same).withColumns({"only_source": F.coalesce("s_n", F.lit(0)), "only_target": F.coalesce("t_n", F.lit(0))})
    status = (
        F.when(F.col("only_target") == 0, "missing_in_target").when(F.col("only_source") == 0, "extra_in_target")
        .when((F.col("only_source") > 1) | (F.col("only_target") > 1), "repeated_key").otherwise("changed")
    )
    differing = F.array_compact(F.array(*[F.when(~F.col(f"s_row.{n}").eqNullSafe(F.col(f"t_row.{n}")), F.lit(n)) for n in rest]))
    return found.withColumn("status", status).select(
        F.lit(table.name).alias("table_name"), F.coalesce("s_key", "t_key").cast("string").alias("row_key"), "status",
        F.when(F.col("status") == "changed", F.array_join(differing, ",")).alias("columns"),
        F.col("only_source").cast("bigint").alias("only_source"), F.col("only_target").cast("bigint").alias("only_target"),
    )


def key_set_diff(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys that exist on one side only."""
    found = _differences(source.select(key).distinct(), target.select(key).distinct(), F.col(key), {})
    return found.select(F.col("_key").cast("string").alias("row_key"), "status")


def anchor_diff(original: DataFrame, loaded: DataFrame, table: Table, column: str) -> DataFrame:
    """Loaded text against the file it came from, byte for byte.

    Comparing two databases proves a faithful move, never that the thing moved was
    right. Keys missing on a side are reported as well.
    """
    found = _differences(original, loaded, canonical(table, table.key), {column: F.col(column)})
    return found.select(
        F.lit(table.name).alias("table_name"),
        F.col("_key").cast("string").alias("row_key"),
        "status",
        F.col(f"s_{column}").alias("file_value"),
        F.col(f"t_{column}").alias("table_value"),
    )
