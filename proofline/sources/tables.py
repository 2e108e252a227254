"""Tables as immutable folders plus a small commit log.

A load writes a fresh folder, counts what it wrote, and only then adds a commit
line; readers follow the last committed line. A job that dies half way leaves an
unreferenced folder and the table as it was, so a load can always be repeated.
One writer per table is assumed.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.contract import Contract, Table
from proofline.functions.conform import ERROR_LIST, ERRORS, conform, rejects
from proofline.session import two_writers

COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("mode", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("seq", T.LongType()),
        T.StructField("tag", T.StringType()),
    ]
)


class LoadError(RuntimeError):
    """A load that must not become visible."""


@dataclass(frozen=True)
class Commit:
    version: int
    mode: str
    folder: str
    rows: int
    seconds: float
    seq: int | None = None
    tag: str | None = None

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


def path_exists(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    try:
        spark.read.schema(schema).json(path)
        return True
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def one_row(spark: SparkSession, schema: T.StructType, values: list) -> DataFrame:
    """A row of literals; needs no Python worker."""
    cells = zip(schema.fields, values)
    return spark.range(1).coalesce(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in cells])


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._log = f"{self.path}/_commits"

    # -- reading -----------------------------------------------------------

    def commits(self) -> list[Commit]:
        """The commit log: one line per load, never one per row."""
        if not path_exists(self.spark, self._log, COMMIT):
            return []
        lines = self.spark.read.schema(COMMIT).json(self._log).orderBy("version").collect()
        return [Commit(**r.asDict()) for r in lines]

    def live(self, version: int | None = None) -> list[Commit]:
        """Commits that make up a version: the last replacement and what was appended since."""
        known = [c for c in self.commits() if version is None or c.version <= version]
        starts = [i for i, c in enumerate(known) if c.mode == "replace"]
        return known[starts[-1] :] if starts else known

    def exists(self) -> bool:
        return bool(self.commits())

    def read(self, version: int | None = None) -> DataFrame:
        folders = [f"{self.path}/{c.folder}" for c in self.live(version)]
        if not folders:
            raise LoadError(f"{self.path} has no committed version")
        return self.spark.read.parquet(*folders)

    # -- writing -----------------------------------------------------------

    def stage(self, df: DataFrame, partition_by: list[str] | None = None) -> tuple[str, int, float]:
        """Write a fresh folder and check that it holds the rows that went in."""
        folder = f"data-{uuid.uuid4().hex}"
        target = f"{self.path}/{folder}"
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        started = time.monotonic()
        writer.parquet(target)
        seconds = time.monotonic() - started
        rows = seen.get["rows"]
        landed = self.spark.read.schema(df.schema).parquet(target).count()
        if landed != rows:
            raise LoadError(f"{target}: {rows} rows written, {landed} read back")
        return folder, rows, seconds

    def commit(self, mode: str, folder: str, rows: int, seconds: float, seq: int | None = None, tag: str | None = None) -> Commit:
        done = self.commits()
        entry = Commit((done[-1].version if done else 0) + 1, mode, folder, rows, seconds, seq, tag)
        one_row(self.spark, COMMIT, list(vars(entry).values())).write.mode("append").json(self._log)
        return entry

    def replace(self, df: DataFrame, seq: int | None = None, tag: str | None = None) -> Commit:
        return self.commit("replace", *self.stage(df), seq=seq, tag=tag)

    def append(self, df: DataFrame, tag: str | None = None) -> Commit:
        return self.commit("append", *self.stage(df), tag=tag)


# -- loading a contract ----------------------------------------------------


@dataclass(frozen=True)
class LoadReport:
    table: str
    rows: int
    rejected: int
    seconds: float
    state: str  # loaded or suspended

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


def full_refresh(
    spark: SparkSession,
    contract: Contract,
    frames: dict[str, DataFrame],
    root: str,
    policy: str = "log",
    reject_limit: int = 0,
    append: bool = False,
) -> list[LoadReport]:
    """Conform and load every given table, parents first.

    Each source is read once: good rows and rejects of one pass go to the same
    fresh folder, split by its ``rejected`` partition. Policies: ``log`` loads the
    good rows, ``suspend`` leaves a table with more than ``reject_limit`` rejects at
    its previous version, ``stop`` ends the whole load before anything is visible.
    All tables are staged before the first becomes visible.
    """
    if policy not in ("log", "suspend", "stop"):
        raise ValueError(f"unknown reject policy {policy!r}")
    staged = []
    for name in contract.names:
        if name not in frames:
            continue
        table = contract.table(name)
        rows = conform(frames[name], table, contract.source_timezone).withColumn("rejected", F.size(ERRORS) > 0)
        store = VersionedTable(spark, f"{root}/{name}")
        with two_writers(spark):
            folder, total, seconds = store.stage(rows, partition_by=["rejected"])
        bad = spark.read.schema(rows.schema).parquet(f"{store.path}/{folder}").where("rejected").count()
        if policy == "stop" and bad > reject_limit:
            raise LoadError(f"{name}: {bad} rows do not conform; nothing was loaded")
        staged.append((table, store, folder, total, bad, seconds))
    reports = []
    for table, store, folder, total, bad, seconds in staged:
        suspended = policy == "suspend" and bad > reject_limit
        if not suspended:
            store.commit("append" if append else "replace", folder, total - bad, seconds)
        reports.append(LoadReport(table.name, total - bad, bad, seconds, "suspended" if suspended else "loaded"))
    return reports


def read_loaded(spark: SparkSession, contract: Contract, root: str, name: str, version: int | None = None) -> DataFrame:
    """Good rows of a loaded table; the partition filter keeps reject files unread."""
    table = contract.table(name)
    schema = T.StructType(table.struct().fields + [T.StructField("rejected", T.BooleanType())])
    return _folders(spark, f"{root}/{name}", schema, version).where(~F.col("rejected")).drop("rejected")


def read_rejects(spark: SparkSession, contract: Contract, root: str, name: str, version: int | None = None) -> DataFrame:
    table = contract.table(name)
    schema = T.StructType(
        table.struct().fields + [T.StructField(ERRORS, ERROR_LIST), T.StructField("rejected", T.BooleanType())]
    )
    return rejects(_folders(spark, f"{root}/{name}", schema, version).where("rejected").drop("rejected"), table)


def _folders(spark: SparkSession, path: str, schema: T.StructType, version: int | None) -> DataFrame:
    store = VersionedTable(spark, path)
    live = store.live(version)
    if not live:
        raise LoadError(f"{path} has no committed version")
    frames = [spark.read.schema(schema).parquet(f"{store.path}/{c.folder}") for c in live]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def loaded_metrics(reports: list[LoadReport], spark: SparkSession) -> DataFrame:
    """Rows, rejects, seconds and rows per second of each loaded table."""
    return spark.createDataFrame(
        [(r.table, r.rows, r.rejected, r.seconds, r.rows_per_second, r.state) for r in reports],
        "table_name string, rows long, rejected long, seconds double, rows_per_second double, state string",
    )


def refresh_statistics(spark: SparkSession, catalog_table: str, table: Table) -> None:
    """Statistics of a catalog table, so the next plan does not take it for empty."""
    columns = ", ".join(f"`{n}`" for n in table.names())
    spark.sql(f"ANALYZE TABLE {catalog_table} COMPUTE STATISTICS FOR COLUMNS {columns}")


def clustered(df: DataFrame, column: str, key: str, files: int | None = None) -> DataFrame:
    """Rows laid out by ``column``, so row-group ranges prune a range scan.

    The key breaks ties: a single moment holding a third of the rows still splits.
    """
    parts = df.repartitionByRange(files, column, key) if files else df.repartitionByRange(column, key)
    return parts.sortWithinPartitions(column, key)
