"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the results depend on. Day boundaries follow the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(
    app: str = "proofline", cores: str = "*", shuffle_partitions: int = 8, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    values = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **(extra or {}),
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in values.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder the cluster names.

    Only a local master may fall back to a folder of this machine, because only
    there every task can read it.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for one write; dots are written as double underscores."""
    names = {n.replace("__", "."): v for n, v in values.items()}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def spread_writes(spark: SparkSession):
    """Let a write into many folders keep its parallelism although its bytes are few.

    Opening a file costs more than filling it here, so the size below which adaptive
    execution merges tasks is lowered. Large writes are not affected by it.
    """
    return settings(spark, spark__sql__adaptive__coalescePartitions__minPartitionSize="64KB")


def two_writers(spark: SparkSession):
    """Write into two folders with two open files per task instead of a sort."""
    return settings(spark, spark__sql__maxConcurrentOutputFileWriters="2")
