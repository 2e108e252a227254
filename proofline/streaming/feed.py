"""A stored change log replayed as a stream, and what the stream reports about itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STATUS = "batch_id long, changes long, inserts long, updates long, deletes long, last_seq long, last_commit timestamp"


def replay(changes: DataFrame, path: str, parts: int, at: str = "commit_ts") -> DataFrame:
    """A stream of ``changes`` in ``parts`` batches of equal spans of time, the oldest first.

    Each span is written before the next one, as the file source takes files by their age; a
    span without rows makes no batch.
    """
    spark = changes.sparkSession
    low, high = changes.agg(F.unix_micros(F.min(at)), F.unix_micros(F.max(at))).first()
    width = 0 if low is None else (high - low) // parts + 1
    for n in range(parts if low is not None else 0):
        micros = F.unix_micros(at)
        part = changes.where((micros >= low + n * width) & (micros < low + (n + 1) * width))
        part.coalesce(1).write.mode("append").parquet(path)
    if low is None:
        changes.write.parquet(path)
    return spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(path)


def watched(changes: DataFrame) -> DataFrame:
    """The stream with measures of each batch, taken while its rows pass."""
    op = F.col("op")
    return changes.observe(
        "changes", F.count(F.lit(1)).alias("changes"), F.count_if(op == "I").alias("inserts"), F.count_if(op == "U").alias("updates"),
        F.count_if(op == "D").alias("deletes"), F.max("seq").alias("last_seq"), F.unix_micros(F.max("commit_ts")).alias("last_commit"),
    )


def status(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The status table of a finished run of a watched stream: one row for each batch that had rows.

    The rows come from the progress Spark keeps (spark.sql.streaming.numRecentProgressUpdates).
    """
    rows = []
    for progress in query.recentProgress:
        seen = progress["observedMetrics"].get("changes")
        if seen is not None and seen["changes"]:
            rows.append((progress["batchId"], *(seen[c] for c in ("changes", "inserts", "updates", "deletes", "last_seq", "last_commit"))))
    found = spark.createDataFrame(rows, STATUS.replace("last_commit timestamp", "last_commit long"))
    return found.withColumn("last_commit", F.timestamp_micros("last_commit"))
