"""Change counts per time slot, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT = "5 minutes"
LATENESS = "10 minutes"


def change_history(changes: DataFrame, slot: str = SLOT, lateness: str = LATENESS, by: list[str] | None = None) -> DataFrame:
    """Changes and last position per slot and operation.

    On a stream the watermark closes slots and bounds the state; on a batch it does
    nothing, so both give the same rows for closed slots.
    """
    keyed = changes.withWatermark("commit_ts", lateness) if changes.isStreaming else changes
    counted = keyed.groupBy(F.window("commit_ts", slot).alias("w"), *(by or ["op"])).agg(
        F.count(F.lit(1)).alias("changes"), F.max("seq").alias("last_seq")
    )
    return counted.select(
        F.col("w.start").alias("slot_start"), F.col("w.end").alias("slot_end"), *(by or ["op"]), "changes", "last_seq"
    )


def lag_seconds(applied: Column, committed: Column) -> Column:
    """Seconds between commit at the source and arrival, to the microsecond."""
    micros = F.unix_micros(applied) - F.unix_micros(committed)
    return (micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")


def replication_lag(changes: DataFrame, applied: str = "applied_ts", by: list[str] | None = None) -> DataFrame:
    lag = lag_seconds(F.col(applied), F.col("commit_ts"))
    return changes.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("changes"), F.min(lag).alias("min_lag"), F.max(lag).alias("max_lag")
    )
