"""What the plans must and must not contain."""

import re

import pytest

from proofline.operators import fingerprint as fp, settle
from proofline.plans import payments as pay
from proofline.plans import queries as q

EAGER = {  # run jobs of their own before they return
    "fingerprint_json", "verification_checks", "verification_summary", "summary_job", "summary_run_log", "delimited_load", "utf16_load",
    "full_refresh", "load_rejects", "load_metrics", "clustered_range", "partitioned_export", "export_latest", "export_pruned", "export_of_large_batches",
    "replicate_stream", "change_history_stream", "allocate_batch_keys", "hash_tree_diff",
    "confirmed_mismatches", "stream_status", "row_diff_bucketed",
}


def plan(df, kind="executedPlan"):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("name", sorted(set(q.registered()) - EAGER))
def test_no_python_and_no_product(spark, sf, name):
    text = plan(q.registered()[name](spark, sf))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def scans(df):
    return len(re.findall(r"FileScan parquet", plan(df)))


def test_ungrouped_measures_take_one_scan(spark, sf):
    df = pay.transactions(spark, sf)
    assert scans(fp.long_form(df, "transactions", fp.scalar_measures(pay.TRANSACTIONS, pay.PAYMENTS.case_check))) == 1


def test_a_single_check_reads_only_its_columns(spark, sf):
    text = plan(q.registered()["null_counts"](spark, sf))
    assert "o_totalprice" not in text


def test_range_reaches_the_scan(spark, sf):
    text = plan(q.registered()["settlement_range"](spark, sf))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_orderdate,2001-02-28T00:00", text)
    assert re.search(r"ReadSchema: struct<[^>]*o_totalprice", text) and "o_orderpriority" not in text


def test_transactions_shrink_before_they_meet_merchants(spark, sf):
    df = settle.daily_settlement(pay.transactions(spark, sf), pay.merchants(spark, sf), q.AS_OF, 365, "folded")
    text = plan(df, "optimizedPlan")
    join = text.index("Join Inner")
    assert "Aggregate [merchant_id" in text[join:]


def test_money_is_never_a_float(spark, sf):
    for name, query in q.registered().items():
        if name in EAGER:
            continue
        assert not [c for c, t in query(spark, sf).dtypes if t in ("double", "float")], name


def test_row_compare_needs_no_join(spark, sf):
    assert "Join" not in plan(q.registered()["row_diff"](spark, sf))


def test_stored_layout_prunes_a_range(spark, sf, tmp_path):
    from proofline.sources.tables import clustered

    path = str(tmp_path / "t")
    clustered(pay.transactions(spark, sf), "captured_at", "txn_id", files=4).write.parquet(path)
    text = plan(settle.settlement_range(spark.read.parquet(path), *q.RANGE))
    assert "GreaterThanOrEqual(captured_at," in text and "LessThan(captured_at," in text


def test_days_of_another_table_prune_the_export(spark, sf):
    text = plan(q.registered()["export_of_large_batches"](spark, sf))
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", text)
