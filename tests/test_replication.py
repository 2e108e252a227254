import json
import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.plans import payments as pay
from proofline.sources import changelog
from proofline.streaming import apply, cutover, history, pending
from proofline.streaming.replica import Replica

T0 = datetime(2026, 3, 1)
ROWS = T.StructType([T.StructField("k", T.LongType()), T.StructField("amount", T.DecimalType(19, 4))])
LOG = "k long, seq long, commit_ts timestamp, op string, amount decimal(19,4)"


def log(spark, *changes):
    return spark.createDataFrame([(k, s, T0 + timedelta(seconds=s), op, None if a is None else Decimal(a)) for s, op, k, a in changes], LOG)


def base(spark, **rows):
    return spark.createDataFrame([(int(k[1:]), Decimal(a), -1) for k, a in rows.items()], "k long, amount decimal(19,4), seq long")


def model(start, changes):
    """The rules, one change at a time."""
    rows, present, verdicts = dict(start), set(start), {}
    for seq, op, k, amount in sorted(changes):
        if op == "I":
            verdict = apply.INSERT_EXISTS if k in present else apply.APPLIED
            present.add(k)
        elif op == "U":
            verdict = apply.APPLIED if k in present else apply.UPDATE_MISSING
        else:
            verdict = apply.APPLIED if k in present else apply.IGNORED
            present.discard(k)
        verdicts[seq] = verdict
        if verdict == apply.APPLIED:
            rows[k] = amount if op != "D" else None
            if op == "D":
                del rows[k]
    return rows, verdicts


@pytest.mark.parametrize("seed,block", [(1, 3), (2, 10), (3, 1_000_000), (4, 1)])
def test_apply_against_a_step_by_step_model(spark, seed, block):
    rnd = random.Random(seed)
    start = {k: Decimal(k) for k in range(0, 12, 2)}
    changes = [(s, rnd.choice("IUD"), min(rnd.randrange(20), rnd.randrange(20)), Decimal(s)) for s in range(300)]
    rows, verdicts = model(start, changes)
    frame = spark.createDataFrame([(k, s, T0, op, a) for s, op, k, a in changes], LOG).repartition(5)
    done = apply.apply_changes(base(spark, **{f"k{k}": v for k, v in start.items()}), frame, ["k"], ["amount"], block=block)
    assert {r.k: r.amount for r in done.state.collect()} == rows
    assert {r.seq: r.verdict for r in done.judged.collect()} == verdicts
    assert {r.seq for r in done.errors.collect()} == {s for s, v in verdicts.items() if v in (apply.INSERT_EXISTS, apply.UPDATE_MISSING)}


def test_hot_key_is_split_into_blocks(spark):
    """A key with a third of all changes never fills one window group."""
    n = 30_000
    frame = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"), F.timestamp_seconds("id").alias("commit_ts"),
        F.when(F.col("id") % 6 == 0, "I").when(F.col("id") % 6 == 3, "D").otherwise("I").alias("op"), F.lit(1).cast("decimal(19,4)").alias("amount"),
    )
    empty = spark.createDataFrame([], "k long, amount decimal(19,4), seq long")
    done = apply.apply_changes(empty, frame, ["k"], ["amount"], block=1000)
    assert done.errors.count() == 0
    assert done.state.where("k = 0").count() == 0 and done.state.count() == n - n // 3
    sizes = frame.groupBy("k", F.floor(F.col("seq") / 1000)).count().agg(F.max("count")).first()[0]
    assert sizes <= 1000


def test_load_conflicts_are_ignored(spark):
    judged = apply.judge(log(spark, (1, "I", 1, "1"), (2, "U", 9, "1"), (5, "U", 9, "1")), base(spark, k1="0"), ["k"], load_end=3)
    assert {r.seq: r.verdict for r in judged.collect()} == {1: apply.IGNORED, 2: apply.IGNORED, 5: apply.UPDATE_MISSING}


def test_escalation(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 5), ("c", 9)], "table_name string, errors long")
    state = lambda **k: {r.table_name: r.state for r in apply.escalate(counts, **k).collect()}
    assert set(state().values()) == {"running"}
    assert state(per_table=4) == {"a": "running", "b": "suspended", "c": "suspended"}
    assert {r.task for r in apply.escalate(counts, 4, 1).collect()} == {"stopped"}
    assert {r.task for r in apply.escalate(counts, 4, 2).collect()} == {"running"}
    apply.enforce(apply.escalate(counts, 4, 2))
    with pytest.raises(apply.TaskStopped):
        apply.enforce(apply.escalate(counts, 4, 1))


def test_pending_mismatches(spark):
    now = T0 + timedelta(hours=1)
    seen = spark.createDataFrame([("a", 0), ("b", 31 * 60), ("c", 58 * 60)], "k string, s int").select("k", (F.lit("2026-03-01 00:00:00").cast("timestamp") + F.expr("make_dt_interval(0, 0, 0, s)")).alias("first_seen"))
    differing = spark.createDataFrame([("a",), ("b",), ("d",)], "k string")
    got = {r.k: r.state for r in pending.confirm(seen, differing, now, ["k"]).collect()}
    assert got == {"a": "suspended", "b": "confirmed", "d": "pending"}


def test_pending_table_forgets_what_settled(spark, tmp_path):
    table = pending.PendingMismatches(spark, str(tmp_path / "p"), ["k"])
    frame = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    states = lambda ks, minutes: {r.k: r.state for r in table.update(frame(*ks), T0 + timedelta(minutes=minutes)).collect()}
    assert states(["a", "b"], 0) == {"a": "pending", "b": "pending"}
    assert states(["a"], 6) == {"a": "confirmed"}
    assert states(["a", "b"], 31) == {"a": "suspended", "b": "pending"}


def test_coverage_and_arrival_and_gate(spark):
    covered = spark.createDataFrame([("transactions",), ("merchants",)], "table_name string")
    gaps = cutover.coverage_gap(spark, pay.PAYMENTS, covered)
    assert sorted(r.table_name for r in gaps.collect()) == ["batches", "settlements"]
    state = spark.createDataFrame([(1, Decimal("4321.4321"))], "k long, amount decimal(19,4)")
    proof = lambda k, a: cutover.prove_arrival(state, {"k": k}, {"amount": Decimal(a)}).first()[:2]
    assert proof(1, "4321.4321") == (True, True) and proof(1, "4321.43") == (True, False) and proof(2, "1") == (False, False)
    lag = spark.createDataFrame([(Decimal("2.5"),)], "max_lag decimal(18,6)")
    ok = spark.createDataFrame([(2, True), (3, False)], "failure_class int, passed boolean")
    passed = lambda g: {r.condition: r.passed for r in g.collect()}
    assert passed(cutover.cutover_gate(lag, ok, gaps.where("1=0"), 3.0)) == {"lag": True, "verification": True, "coverage": True}
    assert passed(cutover.cutover_gate(lag.where("1=0"), ok, gaps, 3.0)) == {"lag": False, "verification": True, "coverage": False}


# -- the streaming replica ---------------------------------------------------


def put(folder, name, *changes):
    lines = [
        json.dumps({"table_name": t, "seq": s, "commit_ts": (T0 + timedelta(seconds=s)).isoformat() + "Z", "op": op, "k": k, "amount": a})
        for t, s, op, k, a in changes
    ]
    (folder / name).write_text("\n".join(lines), encoding="utf-8")
    age = 1_700_000_000 + len(list(folder.iterdir()))  # the file source takes the oldest first
    os.utime(folder / name, (age, age))


SCHEMA = T.StructType(changelog.ENVELOPE + list(ROWS.fields))


class Setup:
    def __init__(self, spark, tmp_path, **options):
        self.spark, self.folder, self.root = spark, tmp_path / "log", tmp_path
        self.folder.mkdir()
        self.replica = Replica(spark, str(tmp_path / "replica"), "acc", ROWS, ["k"], **options)
        self.replica.load(base(spark, k1="1", k2="2").drop("seq"), seq=10)

    def run(self):
        stream = changelog.stream_changes(self.spark, str(self.folder), SCHEMA, files_per_batch=1)
        self.replica.follow(stream, str(self.root / "checkpoint")).awaitTermination()

    def rows(self):
        return {r.k: str(r.amount) for r in self.replica.state().collect()}


def test_full_load_then_changes(spark, tmp_path):
    s = Setup(spark, tmp_path)
    put(s.folder, "1.json", ("acc", 9, "D", 1, None), ("acc", 11, "U", 1, "1.5"), ("other", 12, "D", 2, None))
    put(s.folder, "2.json", ("acc", 13, "I", 3, "4321.4321"), ("acc", 14, "D", 2, None), ("acc", 15, "U", 7, "1"))
    s.run()
    assert s.rows() == {1: "1.5000", 3: "4321.4321"}  # seq 9 was part of the load
    assert [(r.k, r.error) for r in s.replica.errors().collect()] == [(7, apply.UPDATE_MISSING)]
    assert s.replica.stats().agg(F.sum("inserts"), F.sum("updates"), F.sum("deletes"), F.sum("errors")).first()[:] == (1, 1, 1, 1)
    assert s.replica.stats().where("max_lag > 0").count() == 2


def test_restart_resumes_and_replay_does_not_repeat(spark, tmp_path):
    s = Setup(spark, tmp_path)
    put(s.folder, "1.json", ("acc", 11, "I", 3, "3"), ("acc", 12, "U", 1, "1.1"))
    s.run()
    put(s.folder, "2.json", ("acc", 13, "U", 3, "3.3"))
    s.run()
    assert s.rows() == {1: "1.1000", 2: "2.0000", 3: "3.3000"}
    again = log(spark, (11, "I", 3, "3"), (12, "U", 1, "1.1"))
    s.replica.apply_batch(again, 0)  # batch 0 once more, as after a crash before its checkpoint
    assert s.rows() == {1: "1.1000", 2: "2.0000", 3: "3.3000"}
    assert s.replica.errors().count() == 0 and s.replica.stats().agg(F.sum("inserts")).first()[0] == 1


def test_a_batch_without_statistics_is_invisible(spark, tmp_path, monkeypatch):
    s = Setup(spark, tmp_path)
    monkeypatch.setattr(Replica, "_finish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        s.replica.apply_batch(log(spark, (11, "D", 1, None)), 0)
    monkeypatch.undo()
    assert s.rows() == {1: "1.0000", 2: "2.0000"}
    s.replica.apply_batch(log(spark, (11, "D", 1, None)), 0)
    assert s.rows() == {2: "2.0000"}


def test_older_changes_are_judged_in_log_order(spark, tmp_path):
    """An insert that arrives after a later update of its key: the update was no error after all."""
    s = Setup(spark, tmp_path)
    s.replica.apply_batch(log(spark, (20, "U", 7, "20"), (21, "D", 2, None)), 0)
    assert s.replica.errors().count() == 1
    s.replica.apply_batch(log(spark, (15, "I", 7, "15"), (16, "U", 2, "16"), (20, "U", 7, "20")), 1)
    assert s.rows() == {1: "1.0000", 7: "20.0000"} and s.replica.errors().count() == 0
    assert s.replica.stats().agg(F.sum("inserts"), F.sum("updates"), F.sum("deletes"), F.sum("errors")).first()[:] == (1, 2, 1, 0)


def test_changes_behind_the_final_position_are_set_aside(spark, tmp_path):
    s = Setup(spark, tmp_path)
    s.replica.apply_batch(log(spark, (20, "U", 1, "20"), (21, "D", 2, None)), 0)
    s.replica.apply_batch(log(spark, (15, "U", 1, "15"), (16, "U", 2, "16")), 1)
    assert s.rows() == {1: "20.0000"}
    s.replica.compact()
    s.replica.apply_batch(log(spark, (9, "D", 1, None), (17, "U", 1, "17"), (18, "I", 2, "18"), (30, "I", 5, "5")), 2)
    assert s.rows() == {1: "20.0000", 5: "5.0000"}
    assert {(r.k, r.seq, str(r.amount)) for r in s.replica.late().collect()} == {(1, 17, "17.0000"), (2, 18, "18.0000")}
    assert s.replica.stats().agg(F.sum("stale")).first()[0] == 2 and s.replica.errors().count() == 0


def test_resume_without_held_changes_lifts_the_suspension(spark, tmp_path):
    s = Setup(spark, tmp_path, error_limit=1)
    s.replica.apply_batch(log(spark, (11, "U", 7, "7"), (12, "U", 8, "8")), 0)
    s.replica.resume()
    assert not s.replica.suspended()
    s.replica.apply_batch(log(spark, (13, "U", 1, "1.3")), 1)
    assert s.rows() == {1: "1.3000", 2: "2.0000"}


def test_reload_keeps_changes_behind_the_snapshot(spark, tmp_path):
    s = Setup(spark, tmp_path)
    s.replica.apply_batch(log(spark, (11, "U", 1, "5"), (12, "U", 9, "9"), (60, "I", 3, "3")), 0)
    s.replica.load(base(spark, k1="8").drop("seq"), 50)
    assert s.rows() == {1: "8.0000", 3: "3.0000"} and [r.k for r in s.replica.errors().collect()] == [9]


def test_shuffled_batches_equal_the_model(spark, tmp_path):
    """Four shuffled batches with a suspension, resumes, a compaction and a replay."""
    rnd = random.Random(3)
    s = Setup(spark, tmp_path, error_limit=2)
    changes = [(seq, rnd.choice("IUUD"), rnd.randrange(6), Decimal(seq)) for seq in range(11, 131)]
    parts = [[] for _ in range(4)]
    for c in changes:
        parts[rnd.randrange(2 if c[0] <= 60 else 4)].append(c)
    for i in range(2):
        s.replica.apply_batch(log(spark, *parts[i]), i)
    s.replica.resume()
    s.replica.resume()
    s.replica.compact(60)
    for i in range(1, 4):
        s.replica.apply_batch(log(spark, *parts[i]), i)
    s.replica.compact()  # whatever is held stays open
    s.replica.resume()
    rows, verdicts = model({1: Decimal(1), 2: Decimal(2)}, changes)
    assert {r.k: r.amount for r in s.replica.state().collect()} == rows
    wrong = {seq for seq, v in verdicts.items() if v in (apply.INSERT_EXISTS, apply.UPDATE_MISSING)}
    assert {r.seq for r in s.replica.errors().collect()} == wrong and s.replica.late().count() == 0
    assert s.replica.stats().agg(F.sum("errors")).first()[0] == len(wrong)


def test_suspended_table_holds_its_changes(spark, tmp_path):
    s = Setup(spark, tmp_path, error_limit=1)
    s.replica.apply_batch(log(spark, (11, "U", 7, "7"), (12, "U", 8, "8")), 0)
    assert s.replica.suspended()
    s.replica.apply_batch(log(spark, (13, "U", 1, "1.3")), 1)
    s.replica.apply_batch(log(spark, (14, "I", 7, "7"), (15, "D", 2, None)), 2)
    assert s.rows() == {1: "1.0000", 2: "2.0000"}
    s.replica.resume()
    assert s.rows() == {1: "1.3000", 7: "7.0000"} and not s.replica.suspended()
    s.replica.apply_batch(log(spark, (16, "U", 7, "7.7")), 3)
    assert s.rows() == {1: "1.3000", 7: "7.7000"}


def test_second_resume_keeps_the_first(spark, tmp_path):
    s = Setup(spark, tmp_path, error_limit=1)
    s.replica.apply_batch(log(spark, (11, "U", 7, "7"), (12, "U", 8, "8")), 0)
    s.replica.apply_batch(log(spark, (13, "U", 1, "1.3"), (14, "I", 7, "7")), 1)
    s.replica.resume()
    before = s.rows()
    s.replica.resume()
    assert s.rows() == before and before[1] == "1.3000"


def test_second_load_replaces_what_was_applied(spark, tmp_path):
    s = Setup(spark, tmp_path)
    s.replica.apply_batch(log(spark, (11, "U", 1, "5")), 0)
    snapshot = s.replica.state().select("k", "amount").where("k = 1").withColumn("amount", F.lit("8").cast("decimal(19,4)"))
    s.replica.load(snapshot, 50)
    assert s.rows() == {1: "8.0000"}


def test_replay_after_compaction_keeps_statistics(spark, tmp_path):
    s = Setup(spark, tmp_path)
    batch = log(spark, (11, "I", 7, "7"), (12, "U", 1, "2"), (13, "U", 9, "9"))
    s.replica.apply_batch(batch, 0)
    s.replica.compact()
    before = s.replica.stats().drop("applied_at").collect()
    s.replica.apply_batch(batch, 0)
    assert s.replica.stats().drop("applied_at").collect() == before and s.replica.errors().count() == 1


def test_many_batches_equal_one(spark, tmp_path):
    rnd = random.Random(7)
    s = Setup(spark, tmp_path)
    changes = [(seq, rnd.choice("IUUD"), rnd.randrange(6), Decimal(seq)) for seq in range(11, 91)]
    for i in range(4):
        s.replica.apply_batch(log(spark, *changes[i * 20 : i * 20 + 20]), i)
        if i == 1:
            s.replica.compact()
    rows, verdicts = model({1: Decimal(1), 2: Decimal(2)}, changes)
    assert {r.k: r.amount for r in s.replica.state().collect()} == rows
    errors = sum(v in (apply.INSERT_EXISTS, apply.UPDATE_MISSING) for v in verdicts.values())
    assert s.replica.stats().agg(F.sum("errors")).first()[0] == errors == s.replica.errors().count()


def test_history_stream_equals_batch_for_closed_slots(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    for i in range(3):
        put(folder, f"{i}.json", *[("acc", i * 1000 + j * 97, "IUD"[j % 3], j, "1") for j in range(10)])
    stream = history.change_history(changelog.stream_changes(spark, str(folder), SCHEMA, files_per_batch=1))
    query = stream.writeStream.format("memory").queryName("slots").outputMode("append").trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
    last = 2000 + 9 * 97
    batch = history.change_history(changelog.read_changes(spark, str(folder), SCHEMA)).where(
        F.col("slot_end") <= F.timestamp_seconds(F.lit(int((T0 - datetime(1970, 1, 1)).total_seconds()) + last - 600))
    )
    slots = spark.table("slots")
    assert slots.count() > 0 and slots.exceptAll(batch).count() == 0 and batch.exceptAll(slots).count() == 0
