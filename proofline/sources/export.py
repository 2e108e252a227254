"""Day-partitioned Parquet export for analytics readers."""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.contract import MONEY
from proofline.functions.conform import trimmed
from proofline.functions.predicates import instant
from proofline.session import spread_writes

DAY = "capture_date"

# What leaves the system: no card and no authorisation columns (fixed values).
EXPORTED = ("txn_id", "merchant_id", "amount", "fee_amount", "currency", "txn_status", "captured_at", "settled_at")


def capture_days(transactions: DataFrame) -> DataFrame:
    return transactions.select(F.to_date("captured_at").alias(DAY)).distinct()


def latest_days(transactions: DataFrame, days: int) -> DataFrame:
    """The ``days`` most recent days that have rows."""
    return capture_days(transactions).orderBy(F.col(DAY).desc()).limit(days)


def export_projection(transactions: DataFrame) -> DataFrame:
    """The exported columns and the day, money exact and padding gone."""
    shaped = {
        "amount": F.col("amount").cast(MONEY),
        "fee_amount": F.col("fee_amount").cast(MONEY),
        "currency": trimmed(F.col("currency")),
    }
    return transactions.select(
        *[shaped.get(c, F.col(c)).alias(c) for c in EXPORTED], F.to_date("captured_at").alias(DAY)
    )


def since_latest_days(transactions: DataFrame, days: int) -> DataFrame:
    """Rows of the latest ``days`` days, as one range predicate the scan can use.

    No day with rows lies between the chosen ones, so the earliest bounds them all.
    """
    first = latest_days(transactions, days).agg(F.min(DAY)).first()[0]
    if first is None:
        return transactions
    return transactions.where(F.col("captured_at") >= instant(datetime.combine(first, time.min)))


def export_by_day(transactions: DataFrame, path: str, days: int | None = None, drop_empty: bool = False) -> None:
    """One pass over all days; each day's folder is replaced as a whole.

    With ``drop_empty`` the frame is the whole truth: once its days are written, exported days without
    rows are deleted, all of them without ``days``, else those after the first of the latest days. Rows
    without a day share one folder, which is only ever replaced.

    Rows are rebalanced by day: small days share a task, and a day holding most of
    the rows is split over several tasks and files instead of filling one.
    """
    if days is not None and days < 1:
        raise ValueError("days must be at least 1")
    rows = export_projection(since_latest_days(transactions, days) if days is not None else transactions)
    writer = (
        rows.hint("rebalance", DAY)
        .sortWithinPartitions(DAY, "txn_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(DAY)
    )
    with spread_writes(transactions.sparkSession):
        writer.parquet(path)
    for day in stale_days(rows, path, from_first=days is not None) if drop_empty else ():
        remove_folder(transactions.sparkSession, f"{path.rstrip('/')}/{DAY}={day.isoformat()}")


def stale_days(rows: DataFrame, path: str, from_first: bool) -> list[date]:
    """Days the export holds and ``rows`` does not, at most one value for each day of the calendar."""
    days = rows.select(DAY).where(f"{DAY} IS NOT NULL").distinct()
    held = rows.sparkSession.read.schema(rows.schema).parquet(path).select(DAY).where(f"{DAY} IS NOT NULL").distinct()
    gone = held.join(days, DAY, "left_anti")
    if from_first:
        first = days.agg(F.min(DAY)).first()[0]
        if first is None:
            return []
        gone = gone.where(F.col(DAY) > F.lit(first))
    return [r[0] for r in gone.collect()]


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_export(spark: SparkSession, path: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """The export, reading only the folders of the days ``lo <= day <= hi``."""
    df = spark.read.parquet(path)
    if lo is not None:
        df = df.where(F.col(DAY) >= F.lit(lo).cast("date"))
    if hi is not None:
        df = df.where(F.col(DAY) <= F.lit(hi).cast("date"))
    return df


def read_export_days(spark: SparkSession, path: str, days: DataFrame) -> DataFrame:
    """The rows of the days in ``days``, another table's; no other folder is read if ``days`` is filtered.

    The different days are broadcast, at most one row for each day of the calendar, and Spark prunes the
    scan by the same broadcast. A NULL day takes nothing.
    """
    return spark.read.parquet(path).join(F.broadcast(days.select(DAY).distinct()), DAY, "left_semi")


def export_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Rows, files and bytes per day, taken from what was written."""
    files = (
        spark.read.parquet(path)
        .groupBy(DAY, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return files.groupBy(DAY).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )
