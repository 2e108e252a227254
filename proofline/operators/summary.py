"""The nightly summary: repeatable by upsert, with a log that survives its own failures."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.contract import MONEY
from proofline.functions.predicates import calendar_start, calendar_window, instant, matches
from proofline.operators.settle import CAPTURED, totals
from proofline.session import spread_writes
from proofline.sources.tables import one_row, path_exists

JOB = "daily_settlement_summary"
KEYS = ["summary_date", "merchant_id"]

SUMMARY = T.StructType(
    [
        T.StructField("merchant_id", T.IntegerType()),
        T.StructField("txn_count", T.LongType()),
        T.StructField("gross_amount", MONEY),
        T.StructField("total_fees", MONEY),
        T.StructField("net_amount", MONEY),
        T.StructField("generated_at", T.TimestampType()),
        T.StructField("summary_date", T.DateType()),
    ]
)

RUN_EVENT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def daily_summary(transactions: DataFrame, as_of: datetime, days_back: int = 1, match: str = "folded") -> DataFrame:
    """Totals per day and merchant from midnight ``days_back`` days before ``as_of``."""
    rows = transactions.where(
        calendar_window(F.col("captured_at"), as_of, days_back) & matches(F.col("txn_status"), CAPTURED, match)
    )
    return rows.groupBy(F.to_date("captured_at").alias("summary_date"), "merchant_id").agg(*totals())


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old ones of the same key; unmatched old rows stay."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


# The parts of a summary that add up, and how a row of transactions contributes to them.
ADDED = {"txn_count": "bigint", "gross_amount": "decimal(38,4)", "total_fees": "decimal(38,4)", "net_amount": "decimal(38,4)"}


def contributions(images: DataFrame, match: str = "folded") -> DataFrame:
    """Signed parts of the summary per day and merchant from row images with ``sign`` (1 in, -1 out).

    An update is its old image out and its new image in, so a row that moves to another day,
    merchant or status leaves one group and joins another.
    """
    rows = images.where(F.col("captured_at").isNotNull() & matches(F.col("txn_status"), CAPTURED, match))
    fee, sign = F.coalesce("fee_amount", F.lit(0).cast(MONEY)), F.col("sign")
    return rows.groupBy(F.to_date("captured_at").alias("summary_date"), "merchant_id").agg(
        F.sum(sign).cast("bigint").alias("txn_count"),
        F.sum(F.col("amount") * sign).cast("decimal(38,4)").alias("gross_amount"),
        F.sum(fee * sign).cast("decimal(38,4)").alias("total_fees"),
        F.sum((F.col("amount") - fee) * sign).cast("decimal(38,4)").alias("net_amount"),
    )


def images_of(changes: DataFrame) -> DataFrame:
    """Signed row images of a change log whose rows hold the structs ``old`` and ``new``, NULL where there is none."""
    out = changes.where("old is not null").select("old.*", F.lit(-1).alias("sign"))
    return out.unionByName(changes.where("new is not null").select("new.*", F.lit(1).alias("sign")))


def maintain(summary: DataFrame, changes: DataFrame, match: str = "folded") -> DataFrame:
    """The summary after the changes (old, new), without reading a transaction.

    ``summary`` has KEYS and the columns of ADDED over all of history. Changes fold to one
    signed row per day and merchant before they meet it; groups without rows go, groups that
    the changes do not touch stay as they are. Raises where a group's count falls below zero:
    the log and the summary do not belong together then.
    """
    signed = contributions(images_of(changes), match)
    both = summary.select(*KEYS, *[F.col(c).cast(t).alias(c) for c, t in ADDED.items()]).unionByName(signed)
    merged = both.groupBy(*KEYS).agg(*[F.sum(c).cast(t).alias(c) for c, t in ADDED.items()])
    checked = F.when(F.col("txn_count") < 0, F.raise_error(F.lit("the changes take out more rows than the summary has")).cast("bigint"))
    return merged.withColumn("txn_count", checked.otherwise(F.col("txn_count"))).where("txn_count > 0")


class RunLog:
    """Append-only job history, written outside the job's own output.

    A run is a start line and an end line. The end line of a failed run is written
    before the error goes on its way, so it cannot be undone with the job.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, run_id: str, job: str, step: int, status: str, rows: int | None = None, error: str | None = None) -> None:
        now = datetime.now(timezone.utc).isoformat()
        one_row(self.spark, RUN_EVENT, [run_id, job, step, now, rows, status, error]).write.mode("append").json(self.path)

    def events(self) -> DataFrame:
        if not path_exists(self.spark, self.path, RUN_EVENT):
            return self.spark.createDataFrame([], RUN_EVENT)
        return self.spark.read.schema(RUN_EVENT).json(self.path)

    def runs(self) -> DataFrame:
        """One row per run, with its latest status; the error is that of its latest line, so a completed run has none."""
        last = lambda c: F.max_by(c, F.struct("step", "at"))
        return (
            self.events()
            .groupBy("run_id", "job_name")
            .agg(
                F.min("at").alias("started_at"),
                F.max(F.when(F.col("status").isin("succeeded", "failed"), F.col("at"))).alias("finished_at"),
                last("rows_written").alias("rows_written"),
                last("status").alias("status"),
                last("error").alias("error"),
            )
        )

    def unfinished(self, job: str) -> list[str]:
        """Runs whose result was staged but never completed, oldest first."""
        found = self.runs().where((F.col("job_name") == job) & (F.col("status") == "staged"))
        return [r.run_id for r in found.orderBy("started_at").select("run_id").collect()]

    def run(self, job: str, work: Callable[[str, Callable[[], None]], int]) -> int:
        """Run ``work(run_id, staged)``, log its outcome, pass its error on."""
        run_id = uuid.uuid4().hex
        self.add(run_id, job, 0, "running")
        staged = False

        def mark() -> None:
            nonlocal staged
            self.add(run_id, job, 1, "staged")
            staged = True

        try:
            rows = work(run_id, mark)
        except Exception as exc:
            # a staged result stays marked as such: the next run completes it
            self.add(run_id, job, 2, "staged" if staged else "failed", error=str(exc))
            raise
        self.add(run_id, job, 2, "succeeded", rows=rows)
        return rows


@dataclass
class SummaryTable:
    """``settlement_summary_daily``, one folder per day, changed by whole days.

    Without MERGE the days a run touches are rebuilt. The rebuilt days are written to
    a staging folder first and copied from there, so an interrupted copy is finished
    by the next run from the staged rows and loses nothing.
    """

    spark: SparkSession
    path: str

    @property
    def log(self) -> RunLog:
        return RunLog(self.spark, f"{self.path}/_runs")

    @property
    def data(self) -> str:
        return f"{self.path}/days"

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.data, SUMMARY):
            return self.spark.createDataFrame([], SUMMARY)
        return self.spark.read.schema(SUMMARY).parquet(self.data)

    def run(self, transactions: DataFrame, as_of: datetime, days_back: int = 1) -> int:
        """Summarise the window and upsert it; returns the rows written by the run."""
        for run_id in self.log.unfinished(JOB):
            try:
                self._publish(run_id)
            except Exception as exc:
                self.log.add(run_id, JOB, 2, "staged", error=str(exc))
                raise
            self.log.add(run_id, JOB, 3, "succeeded", rows=None)

        def work(run_id: str, staged: Callable[[], None]) -> int:
            new = daily_summary(transactions, as_of, days_back).select(
                "merchant_id", "txn_count",
                *[F.col(c).cast(MONEY).alias(c) for c in ("gross_amount", "total_fees", "net_amount")],
                instant(as_of).alias("generated_at"), "summary_date",
            )
            staging = self._staging(run_id)
            new.write.mode("errorifexists").parquet(f"{staging}/new")
            fresh = self.spark.read.schema(SUMMARY).parquet(f"{staging}/new")
            days = fresh.select("summary_date").distinct()
            # the window's first day prunes the folders, the days written decide among the rest
            touched = self.read().where(F.col("summary_date") >= F.lit(calendar_start(as_of, days_back).date()))
            kept = touched.join(days, "summary_date", "left_semi")
            upsert(kept, fresh, KEYS).write.mode("errorifexists").parquet(f"{staging}/days")
            staged()
            self._publish(run_id)
            return fresh.count()

        return self.log.run(JOB, work)

    def _staging(self, run_id: str) -> str:
        return f"{self.path}/_staging/{run_id}"

    def _publish(self, run_id: str) -> None:
        rows = self.spark.read.schema(SUMMARY).parquet(f"{self._staging(run_id)}/days")
        writer = (
            rows.hint("rebalance", "summary_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("summary_date")
        )
        with spread_writes(self.spark):
            writer.parquet(self.data)


def latest_runs(runs: DataFrame) -> DataFrame:
    """The latest run of every job: did last night's job run?"""
    columns = [c for c in runs.columns if c != "job_name"]
    return runs.groupBy("job_name").agg(F.max_by(F.struct(*columns), "started_at").alias("r")).select("job_name", "r.*")
