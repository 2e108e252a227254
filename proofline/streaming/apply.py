"""Applying an ordered change log to keyed rows, as plain frames in and out.

The streaming job and the as-of replay both use these functions, so a stream and a
batch over the same changes cannot disagree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofline.functions.predicates import whole_blocks
from proofline.sources.changelog import DELETE, INSERT, UPDATE

BLOCK = 1_000_000  # log positions per block of the presence scan

# Verdicts on a change (fixed values).
APPLIED, IGNORED = "applied", "ignored"
INSERT_EXISTS, UPDATE_MISSING = "insert of an existing key", "update of a missing key"


def _existence_op() -> Column:
    """True after an insert, False after a delete, NULL for an update."""
    return F.when(F.col("op") == INSERT, True).when(F.col("op") == DELETE, False)


def with_presence(changes: DataFrame, existing: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """Add ``present``: whether the key exists just before each change.

    A key exists after an insert and does not after a delete, valid or not, so each
    change asks the latest insert or delete before it, or, failing that, ``existing``.

    Log positions are unique, so a key has at most ``block`` changes in one block:
    the scan inside a block is bounded however hot the key is. Only the last insert or
    delete of each block travels on to later blocks of the key.
    """
    tagged = changes.withColumn("_block", whole_blocks(F.col("seq"), block))
    inside = Window.partitionBy(*keys, "_block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    scanned = tagged.withColumn("_before", F.last(_existence_op(), ignorenulls=True).over(inside))

    ends = tagged.groupBy(*keys, "_block").agg(
        F.max_by(_existence_op(), F.when(_existence_op().isNotNull(), F.col("seq"))).alias("_end")
    )
    across = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(across))
    # the existing rows stream past the few touched keys before anything is made distinct
    known = existing.select(*keys).join(ends.select(*keys), keys, "left_semi").distinct()
    known = known.withColumn("_existed", F.lit(True))
    carried = carried.join(known, keys, "left").select(
        *keys, "_block", F.coalesce("_carried", "_existed", F.lit(False)).alias("_carried")
    )
    return (
        scanned.join(carried, [*keys, "_block"])
        .withColumn("present", F.coalesce("_before", "_carried"))
        .drop("_block", "_before", "_carried")
    )


def judge(changes: DataFrame, existing: DataFrame, keys: list[str], load_end: int | None = None, block: int = BLOCK) -> DataFrame:
    """Add ``verdict`` to every change by the conflict policy.

    An insert of an existing key and an update of a missing key are errors to be
    logged; a delete of a missing key is ignored. Conflicts at positions up to
    ``load_end`` are ignored too: they fell into the full load.
    """
    present = with_presence(changes, existing, keys, block)
    verdict = (
        F.when((F.col("op") == INSERT) & F.col("present"), INSERT_EXISTS)
        .when((F.col("op") == UPDATE) & ~F.col("present"), UPDATE_MISSING)
        .when((F.col("op") == DELETE) & ~F.col("present"), IGNORED)
        .otherwise(APPLIED)
    )
    if load_end is not None:
        verdict = F.when((F.col("seq") <= load_end) & (verdict != APPLIED), IGNORED).otherwise(verdict)
    return present.withColumn("verdict", verdict)


def is_error() -> Column:
    return F.col("verdict").isin(INSERT_EXISTS, UPDATE_MISSING)


def net_changes(judged: DataFrame, keys: list[str]) -> DataFrame:
    """The last applied change of every key: its row image, or a tombstone for a delete.

    ``max_by`` combines before the shuffle, so a hot key sends one row per task.
    """
    columns = [c for c in judged.columns if c not in (*keys, "present", "verdict")]
    last = F.max_by(F.struct(*columns), "seq").alias("_last")
    return judged.where(F.col("verdict") == APPLIED).groupBy(*keys).agg(last).select(*keys, "_last.*")


def merge(base: DataFrame, net: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows after any number of net changes, computing ``net`` once.

    Keys are unique on both sides, so the join meets no skew.
    """
    old = base.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in (*columns, "seq")])
    new = net.select(*keys, "op", *columns, "seq")
    pick = lambda c: F.when(F.col("op").isNull(), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c)
    both = old.join(new, keys, "full_outer").where(F.col("op").isNull() | (F.col("op") != DELETE))
    return both.select(*keys, *[pick(c) for c in (*columns, "seq")])


class TaskStopped(RuntimeError):
    """Too many tables are suspended to go on."""


@dataclass(frozen=True)
class Applied:
    state: DataFrame
    errors: DataFrame
    judged: DataFrame


def apply_changes(
    base: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], load_end: int | None = None, block: int = BLOCK
) -> Applied:
    """State after all changes, the conflicts on the way, and every change's verdict.

    ``base`` carries the position ``seq`` of the change each row came from.
    """
    judged = judge(changes, base, keys, load_end, block)
    errors = judged.where(is_error()).select(*keys, "seq", "op", F.col("verdict").alias("error"))
    return Applied(merge(base, net_changes(judged, keys), keys, columns), errors, judged)


def as_of(base: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], seq: int) -> DataFrame:
    """State after the changes up to and including position ``seq``."""
    return apply_changes(base, changes.where(F.col("seq") <= seq), keys, columns).state


def table_stats(judged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Applied inserts, updates and deletes, and what was logged or ignored."""
    n = lambda cond: F.count_if(cond)
    done = F.col("verdict") == APPLIED
    return judged.groupBy(*(by or [])).agg(
        n(done & (F.col("op") == INSERT)).alias("inserts"),
        n(done & (F.col("op") == UPDATE)).alias("updates"),
        n(done & (F.col("op") == DELETE)).alias("deletes"),
        n(is_error()).alias("errors"),
        n(F.col("verdict") == IGNORED).alias("ignored"),
    )


def table_report(loaded: DataFrame, stats: DataFrame, differences: DataFrame) -> DataFrame:
    """Per table: rows of the full load, applied changes, and how the row compare went.

    ``loaded`` is (table_name, full_load_rows), ``stats`` is ``table_stats`` by table,
    ``differences`` are rows of the row compare.
    """
    counts = ("full_load_rows", "inserts", "updates", "deletes", "mismatched_rows")

    def part(df: DataFrame) -> DataFrame:
        return df.select("table_name", *[(F.col(c) if c in df.columns else F.lit(0)).cast("bigint").alias(c) for c in counts])

    mismatched = differences.groupBy("table_name").agg(F.count(F.lit(1)).alias("mismatched_rows"))
    summed = (
        part(loaded).unionByName(part(stats)).unionByName(part(mismatched))
        .groupBy("table_name")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    state = F.when(F.col("mismatched_rows") > 0, "mismatched records").otherwise("validated")
    return summed.withColumn("validation_state", state)


def escalate(error_counts: DataFrame, per_table: int = 0, tables: int = 0) -> DataFrame:
    """State of each table under the error limits; a limit of 0 never escalates.

    A table with more than ``per_table`` errors is suspended. With more than ``tables``
    suspended tables the whole task stops.
    """
    over = F.col("errors") > per_table if per_table else F.lit(False)
    states = error_counts.select("table_name", "errors", F.when(over, "suspended").otherwise("running").alias("state"))
    if not tables:
        return states.withColumn("task", F.lit("running"))
    suspended = states.agg(F.count_if(F.col("state") == "suspended")).first()[0]
    return states.withColumn("task", F.lit("stopped" if suspended > tables else "running"))


def enforce(states: DataFrame) -> DataFrame:
    """Raise when the task has to stop, else pass the states on."""
    if not states.where(F.col("task") == "stopped").isEmpty():
        raise TaskStopped("more tables are suspended than the limit allows")
    return states
