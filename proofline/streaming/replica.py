"""A table that follows a change log: full load first, then micro-batches.

A batch never rewrites the table. It appends its changes to a folder named after the
batch, and readers judge all changes kept since the base was written, in log order:
whatever order they arrived in, the state is the one a single batch would give.
``compact`` folds what is final into a new base. A replayed batch overwrites exactly its
own folders, and only the statistics line written last makes a batch visible, so a
restart neither loses nor repeats anything.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from proofline.functions.predicates import instant
from proofline.sources.tables import LoadError, VersionedTable, path_exists
from proofline.streaming.apply import Applied, apply_changes, judge, table_stats
from proofline.streaming.history import lag_seconds

STATS = T.StructType(
    [
        T.StructField("kind", T.StringType()),  # batch, backlog or resume
        *[T.StructField(n, T.LongType()) for n in ("inserts", "updates", "deletes", "errors", "ignored", "stale", "held")],
        T.StructField("last_seq", T.LongType()),
        T.StructField("max_lag", T.DecimalType(18, 6)),
        T.StructField("applied_at", T.TimestampType()),
        T.StructField("batch", T.LongType()),
    ]
)


class Replica:
    """One replicated table. ``rows`` is its schema without the position column."""

    def __init__(
        self, spark: SparkSession, path: str, table: str, rows: T.StructType, keys: list[str],
        error_limit: int = 0, load_end: int | None = None,
    ):
        self.spark, self.path, self.table = spark, path.rstrip("/"), table
        self.keys, self.rows = keys, rows
        self.columns = [f.name for f in rows.fields if f.name not in keys]
        self.error_limit, self.load_end = error_limit, load_end
        self.base = VersionedTable(spark, f"{self.path}/base")
        self.closed = VersionedTable(spark, f"{self.path}/closed")  # errors of changes that are folded in
        key_fields = [rows[k] for k in keys]
        value_fields = [rows[c] for c in self.columns]
        tail = [
            T.StructField("seq", T.LongType()),
            T.StructField("commit_ts", T.TimestampType()),
            T.StructField("op", T.StringType()),
        ]
        self._changes = T.StructType([*key_fields, *value_fields, *tail])
        self._held_rows = T.StructType([*self._changes.fields, T.StructField("batch", T.LongType())])
        self._stored = T.StructType([*self._changes.fields, T.StructField("late", T.BooleanType()), T.StructField("batch", T.LongType())])

    # -- full load ---------------------------------------------------------

    def load(self, snapshot: DataFrame, seq: int) -> None:
        """Take a snapshot that holds every change up to position ``seq``; later changes stay on top of it."""
        rows = snapshot.select(*self.keys, *self.columns, F.lit(seq).cast("long").alias("seq"))
        if self.base.live():
            self._close(self._applied(), seq)
        self.base.replace(rows, seq=seq, tag=str(seq))

    def _close(self, applied: Applied, seq: int) -> None:
        """Keep the errors up to ``seq``, whose changes the next base folds in; they count once that base is there."""
        errors = self._closed_errors().unionByName(self._shown(applied)).where(F.col("seq") <= seq)
        self.closed.replace(errors, seq=seq, tag=str(self._base().version + 1))

    # -- reading -----------------------------------------------------------

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        where = f"{self.path}/{part}"
        if not path_exists(self.spark, where, schema):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(where)

    def stats(self) -> DataFrame:
        """One line per visible batch."""
        return self._read("stats", STATS)

    def errors(self) -> DataFrame:
        """Every conflict, as log order decides it."""
        return self._closed_errors().unionByName(self._shown(self._applied()))

    def _shown(self, applied: Applied) -> DataFrame:
        return applied.errors.select(*self.keys, "seq", "op", "error")

    def _closed_errors(self) -> DataFrame:
        version = self._base().version
        known = [c for c in self.closed.commits() if int(c.tag) <= version]
        if known:
            return self.closed.read(known[-1].version)
        fields = [*[self.rows[k] for k in self.keys], T.StructField("seq", T.LongType()), T.StructField("op", T.StringType()), T.StructField("error", T.StringType())]
        return self.spark.createDataFrame([], T.StructType(fields))

    def late(self) -> DataFrame:
        """Changes that came behind the position declared final: whole, and not applied."""
        return self._visible(self._read("changes", self._stored).where("late")).drop("late")

    def _visible(self, df: DataFrame, before: int | None = None) -> DataFrame:
        done = self.stats().select("batch")
        if before is not None:
            done = done.where(F.col("batch") < before)
        return df.join(done, "batch", "left_semi")

    def _base(self):
        live = self.base.live()
        if not live:
            raise LoadError(f"{self.table}: load a snapshot before applying changes")
        return live[-1]

    def _kept(self, before: int | None = None) -> DataFrame:
        """Changes behind the base, each position once however often it was delivered."""
        open_ = self._visible(self._read("changes", self._stored).where(F.col("seq") > self._base().seq), before)
        return open_.drop("late", "batch").dropDuplicates([*self.keys, "seq"])

    def _applied(self, before: int | None = None, through: int | None = None) -> Applied:
        kept = self._kept(before)
        if through is not None:
            kept = kept.where(F.col("seq") <= through)
        return apply_changes(self.base.read(), kept, self.keys, self.columns, self.load_end)

    def state(self, before: int | None = None) -> DataFrame:
        """The table as of the last visible batch, with the position of each row."""
        return self._applied(before).state

    def suspended(self, before: int | None = None) -> bool:
        """More errors than the limit since the last resume; a limit of 0 never suspends."""
        if not self.error_limit:
            return False
        lines = self.stats() if before is None else self.stats().where(F.col("batch") < before)
        resumed = lines.agg(F.coalesce(F.max(F.when(F.col("kind") == "resume", F.col("batch"))), F.lit(-1))).first()[0]
        errors = lines.where(F.col("batch") > resumed).agg(F.coalesce(F.sum("errors"), F.lit(0))).first()[0]
        return errors > self.error_limit

    # -- applying ----------------------------------------------------------

    def apply_batch(self, changes: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body. Stream batches take even numbers, resumes odd ones."""
        batch = 2 * batch_id
        if not self.stats().where(F.col("batch") == batch).isEmpty():
            # applied before: after a compaction nothing may be judged against its own effect
            return
        mine = changes.select(*[F.col(f.name).cast(f.dataType) for f in self._changes.fields])
        if self.suspended(batch):
            self._hold(mine, batch)
        else:
            self._apply(mine, batch, "batch")

    def _write(self, df: DataFrame, part: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{part}/batch={batch}")

    def _finish(self, line: DataFrame, kind: str, batch: int) -> None:
        names = [f for f in STATS.fields if f.name != "batch"]
        full = line.withColumn("kind", F.lit(kind)).withColumn("applied_at", instant(datetime.now(timezone.utc)))
        have = set(full.columns)
        cells = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in names]
        self._write(full.select(*cells).coalesce(1), "stats", batch)

    def _hold(self, changes: DataFrame, batch: int) -> None:
        """Changes of a suspended table wait; none is dropped."""
        self._write(changes, "backlog", batch)
        held = self.spark.read.schema(self._changes).parquet(f"{self.path}/backlog/batch={batch}")
        self._finish(held.agg(F.count(F.lit(1)).alias("held"), F.max("seq").alias("last_seq")), "backlog", batch)

    def _apply(self, changes: DataFrame, batch: int, kind: str) -> None:
        """Store the batch and count what it changes: an older change may turn verdicts on newer ones of its key."""
        base = self._base()
        now = instant(datetime.now(timezone.utc))
        loaded = F.coalesce(F.col("seq") <= int(base.tag), F.lit(False))
        late = ~F.coalesce(F.col("seq") > base.seq, F.lit(False))
        self._write(changes.where(~loaded).withColumn("late", late), "changes", batch)
        mine = self.spark.read.schema(T.StructType(self._stored.fields[:-1])).parquet(f"{self.path}/changes/batch={batch}")
        new = mine.where("not late").drop("late")

        touched = new.select(*self.keys).distinct()
        before = self._kept(batch).join(touched, self.keys, "left_semi")
        after = before.unionByName(new).dropDuplicates([*self.keys, "seq"])
        rows = self.base.read()
        verdicts = lambda log, weight: judge(log, rows, self.keys, self.load_end).select("op", "verdict", F.lit(weight).alias("weight"))
        counted = table_stats(verdicts(after, 1).unionByName(verdicts(before, -1)), ["weight"])
        names = [c for c in counted.columns if c != "weight"]
        line = counted.agg(*[F.coalesce(F.sum(F.col(c) * F.col("weight")), F.lit(0)).alias(c) for c in names])
        seen = mine.agg(
            F.max(F.when(~F.col("late"), F.col("seq"))).alias("last_seq"), F.count_if("late").alias("late"),
            F.max(F.when(~F.col("late"), lag_seconds(now, F.col("commit_ts")))).alias("max_lag"),
        ).first()
        line = line.withColumns(
            {"stale": F.lit(seen.late), "last_seq": F.lit(seen.last_seq).cast("long"), "max_lag": F.lit(seen.max_lag).cast("decimal(18,6)")}
        )
        self._finish(line, kind, batch)

    def _held(self) -> DataFrame:
        done = self.stats().agg(F.coalesce(F.max(F.when(F.col("kind") == "resume", F.col("batch"))), F.lit(-1))).first()[0]
        return self._visible(self._read("backlog", self._held_rows)).where(F.col("batch") > done)

    def resume(self) -> None:
        """Apply what was held while the table was suspended, then go on; nothing to do on a running table."""
        held = self._held()
        if not self.suspended() and held.isEmpty():
            # the newest batch may be an earlier resume, whose changes must stay
            return
        newest = self.stats().agg(F.max("batch")).first()[0]
        self._apply(held.drop("batch"), (newest // 2) * 2 + 1, "resume")

    def compact(self, final: int | None = None) -> None:
        """Fold the changes up to position ``final`` into a new base; they are not judged again.

        The caller declares that no change at or below ``final`` is still to come; by default that is
        the newest position applied. One that comes nevertheless is shown by ``late`` and counted as
        stale. Changes that a suspended table holds are never closed off.
        """
        newest = self.stats().agg(F.max(F.when(F.col("kind") != "backlog", F.col("last_seq")))).first()[0]
        held = self._held().agg(F.min("seq")).first()[0]
        known = [p for p in (newest if final is None else final, None if held is None else held - 1) if p is not None]
        base = self._base()
        if not known or min(known) <= base.seq:
            return
        applied = self._applied(through=min(known))
        self._close(applied, min(known))
        self.base.replace(applied.state.select(*self.keys, *self.columns, "seq"), seq=min(known), tag=base.tag)

    def follow(self, changes: DataFrame, checkpoint: str, once: bool = True, poll: str = "3 seconds") -> StreamingQuery:
        """Start applying a change stream; ``once`` takes what is there and ends."""
        if "table_name" in changes.columns:
            changes = changes.where(F.col("table_name") == self.table)
        writer = changes.writeStream.foreachBatch(self.apply_batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)).start()

