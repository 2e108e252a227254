from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from proofline.operators import orphans, projections, settle, summary
from proofline.contract import ContractError
from proofline.plans import payments as pay

T0 = datetime(2026, 3, 1, 12)


def txns(spark, *rows):
    data = [(i, m, Decimal(a), None if f is None else Decimal(f), s, c, st) for i, m, a, f, s, c, st in rows]
    return spark.createDataFrame(
        data,
        "txn_id long, merchant_id int, amount decimal(19,4), fee_amount decimal(19,4), txn_status string, captured_at timestamp, settled_at timestamp",
    )


def sample(spark):
    return txns(
        spark,
        (1, 1, "10.0001", "0.5", "Captured", T0, T0),
        (2, 1, "-4.0000", None, "captured", T0 + timedelta(hours=1), T0),
        (3, 1, "1.1500", "0.01", "CAPTURED", T0 + timedelta(days=1), None),
        (4, 2, "8.2000", "0.02", "Voided", T0, None),
        (5, 9, "0.0100", "0.00", "Captured", T0, T0),
    )


def names(spark):
    return spark.createDataFrame([(1, "one"), (2, "two")], "merchant_id int, legal_name string")


def test_report_modes(spark):
    report = lambda match: settle.report_order(settle.daily_settlement(sample(spark), names(spark), T0 + timedelta(days=2), 7, match)).collect()
    assert [(r.merchant_id, r.txn_count, r.gross_amount, r.total_fees, r.net_amount) for r in report("exact")] == [
        (1, 1, Decimal("10.0001"), Decimal("0.5000"), Decimal("9.5001"))
    ]
    folded = report("folded")
    assert [(str(r.capture_date), r.txn_count) for r in folded] == [("2026-03-02", 1), ("2026-03-01", 2)]
    assert folded[1].net_amount == Decimal("5.5001")


def test_an_id_with_two_names_is_reported_under_both(spark):
    twice = names(spark).unionByName(spark.createDataFrame([(1, "uno"), (1, "one")], "merchant_id int, legal_name string"))
    rows = settle.daily_settlement(sample(spark), twice, T0 + timedelta(days=2), 7, "exact").collect()
    assert {(r.legal_name, r.txn_count) for r in rows} == {("one", 2), ("uno", 1)}


def test_batches_and_settlements(spark):
    batches = settle.derive_batches(sample(spark))
    got = {(r.merchant_id, str(r.batch_date)): (r.txn_count, r.gross_amount, r.batch_status) for r in batches.collect()}
    assert got == {
        (1, "2026-03-01"): (2, Decimal("6.0001"), "Settled"),
        (1, "2026-03-02"): (1, Decimal("1.1500"), "Pending"),
        (9, "2026-03-01"): (1, Decimal("0.0100"), "Settled"),
    }
    paid = {r.merchant_id: r for r in settle.derive_settlements(batches).withColumn("settled_at", F.col("settled_at").cast("string")).collect()}
    assert paid[1].net_amount == Decimal("5.8231") and paid[1].fee_amount == Decimal("0.1770")
    assert paid[9].net_amount == Decimal("0.0097") and paid[9].fee_amount == Decimal("0.0003")
    assert paid[1].settled_at == "2026-03-03 00:00:00"


def test_upsert_keeps_the_unmatched(spark, tmp_path):
    job = summary.SummaryTable(spark, str(tmp_path / "s"))
    as_of = T0 + timedelta(days=1)
    assert job.run(sample(spark), as_of, 1) == 3
    later = txns(spark, (6, 1, "100.0000", "1.0", "captured", T0, T0))  # merchant 9 is gone from this source
    assert job.run(later, as_of, 1) == 1
    assert job.run(later, as_of, 1) == 1
    got = {(str(r.summary_date), r.merchant_id): r.gross_amount for r in job.read().collect()}
    assert got == {("2026-03-01", 1): Decimal("100.0000"), ("2026-03-01", 9): Decimal("0.0100"), ("2026-03-02", 1): Decimal("1.1500")}
    runs = job.log.runs()
    assert runs.where("status = 'succeeded' AND finished_at >= started_at").count() == 3
    assert summary.latest_runs(runs).first().rows_written == 1


def test_failure_is_recorded_and_raised(spark, tmp_path):
    job = summary.SummaryTable(spark, str(tmp_path / "s"))
    job.run(sample(spark), T0, 1)
    broken = sample(spark).withColumn("amount", F.raise_error(F.lit("disk on fire")).cast("decimal(19,4)"))
    with pytest.raises(Exception, match="disk on fire"):
        job.run(broken, T0, 1)
    failed = job.log.runs().where("status = 'failed'").collect()
    assert len(failed) == 1 and "disk on fire" in failed[0].error and failed[0].rows_written is None
    assert job.read().count() == 3


def test_interrupted_publishing_is_completed_by_the_next_run(spark, tmp_path, monkeypatch):
    job = summary.SummaryTable(spark, str(tmp_path / "s"))
    as_of = T0 + timedelta(days=1)
    job.run(sample(spark), as_of, 1)

    def dies(self, run_id):
        raise RuntimeError("executor lost")

    publish = summary.SummaryTable._publish
    monkeypatch.setattr(summary.SummaryTable, "_publish", dies)
    later = txns(spark, (6, 9, "7.0000", "0.0", "captured", T0, T0))
    with pytest.raises(RuntimeError):
        job.run(later, as_of, 1)
    left = lambda: [(r.status, r.error) for r in job.log.runs().where("status <> 'succeeded'").collect()]
    assert left() == [("staged", "executor lost")]
    with pytest.raises(RuntimeError):
        job.run(later, as_of, 1)
    assert left() == [("staged", "executor lost")] and job.log.events().where("error IS NOT NULL").count() == 2
    monkeypatch.setattr(summary.SummaryTable, "_publish", publish)
    job.run(txns(spark, (7, 1, "3.0000", "0.0", "captured", T0 + timedelta(days=1), T0)), as_of, 1)
    got = {(str(r.summary_date), r.merchant_id): r.gross_amount for r in job.read().collect()}
    assert got == {("2026-03-01", 1): Decimal("6.0001"), ("2026-03-01", 9): Decimal("7.0000"), ("2026-03-02", 1): Decimal("3.0000")}
    assert job.log.runs().where("status <> 'succeeded'").count() == 0


def test_orphans_count_null_keys_and_list_zero(spark):
    parents = spark.createDataFrame([(1,), (2,)], "merchant_id int")
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "merchant_id int")
    count = lambda c: orphans.orphan_count(c, "merchant_id", parents, "merchant_id", "x").first().orphan_count
    assert count(child) == 3 and count(parents) == 0


def test_published_columns_are_exact(spark, sf):
    rows = projections.project(pay.merchants(spark, sf), pay.PUBLIC_MERCHANT)
    projections.assert_published(rows, pay.PUBLIC_MERCHANT)
    with pytest.raises(ContractError):
        projections.assert_published(rows.withColumn("mcc", F.lit("5411")), pay.PUBLIC_MERCHANT)
