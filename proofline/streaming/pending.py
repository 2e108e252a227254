"""Mismatches seen while changes are in flight, and when they become findings."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.functions.predicates import instant
from proofline.sources.tables import VersionedTable

REPORT_AFTER = 300  # seconds
SUSPEND_AFTER = 1800
LATENESS = "10 minutes"


def confirm(
    pending: DataFrame, mismatches: DataFrame, now: datetime, keys: list[str],
    report_after: int = REPORT_AFTER, suspend_after: int = SUSPEND_AFTER,
) -> DataFrame:
    """The next pending table: what still differs, since when, and how serious that is.

    ``pending`` has ``keys`` and ``first_seen``. A difference that no longer shows was
    only a change under way and drops out; a new one starts now. ``state`` is pending,
    confirmed after ``report_after`` seconds, suspended after ``suspend_after``.
    """
    seen = mismatches.select(*keys).distinct().join(
        pending.select(*keys, "first_seen"), keys, "left"
    )
    first = F.coalesce("first_seen", instant(now))
    age = F.unix_seconds(instant(now)) - F.unix_seconds(first)
    state = F.when(age >= suspend_after, "suspended").when(age >= report_after, "confirmed").otherwise("pending")
    return seen.select(*keys, first.alias("first_seen"), state.alias("state"))


def unresolved(mismatches: DataFrame, matches: DataFrame, keys: list[str], after: int, lateness: str = LATENESS) -> DataFrame:
    """Mismatches (keys, seen_at) without a match (keys, matched_at) in the ``after`` seconds from when they were seen.

    On streams a mismatch waits in the join's state until both watermarks have passed its
    last moment; then it comes out, once, or has gone because a match came. The interval
    bounds the state of both sides. On batches every mismatch is judged, as nothing more
    can come. A NULL key meets no match.
    """
    left, right = mismatches.select(*keys, "seen_at"), matches.select(*[F.col(k).alias(f"_m_{k}") for k in keys], "matched_at")
    if left.isStreaming:
        left, right = left.withWatermark("seen_at", lateness), right.withWatermark("matched_at", lateness)
    same = [F.col(k) == F.col(f"_m_{k}") for k in keys]
    within = F.expr(f"matched_at >= seen_at AND matched_at <= seen_at + INTERVAL {after} SECONDS")
    joined = left.join(right, reduce(lambda a, b: a & b, same) & within, "left_outer")
    return joined.where("matched_at is null").select(*keys, "seen_at")


class PendingMismatches:
    """The pending table of one replicated table, compared again after each batch."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.store, self.keys = VersionedTable(spark, path), keys

    def update(self, mismatches: DataFrame, now: datetime) -> DataFrame:
        """Store and return the next pending table; ``mismatches`` carries the keys that differ."""
        if self.store.exists():
            known = self.store.read()
        else:
            known = mismatches.select(*self.keys).where("false").withColumn("first_seen", instant(now))
        self.store.replace(confirm(known, mismatches, now, self.keys))
        return self.store.read()
