"""The ordered change log as a stream or as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from proofline.contract import Table

INSERT, UPDATE, DELETE = "I", "U", "D"

# Fields every change carries besides the row image (fixed values).
ENVELOPE = [
    T.StructField("table_name", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("commit_ts", T.TimestampType()),
    T.StructField("op", T.StringType()),
]


def change_schema(table: Table) -> T.StructType:
    """Envelope plus the stored columns: the full row after the change, or the key of a delete."""
    return T.StructType(ENVELOPE + [T.StructField(c.name, c.spark_type) for c in table.stored])


def read_changes(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", **options: str) -> DataFrame:
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def stream_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Files become micro-batches in arrival order; a cap per batch bounds its size."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(path)
