"""Every planted fault turns exactly its own checks red."""

import pytest
from pyspark.sql import functions as F

from proofline.contract import Contract
from proofline.functions.conform import add_generated
from proofline.operators import checks, compare, settle
from proofline.operators import fingerprint as fp
from proofline.plans import payments as pay

CONTRACT = pay.PAYMENTS
TXN = "transactions"


@pytest.fixture(scope="module")
def clean(spark, sf, tmp_path_factory):
    """Merchants and transactions, written once."""
    root = tmp_path_factory.mktemp("clean")
    out = {}
    for name, df in (("merchants", pay.merchants(spark, sf)), (TXN, pay.transactions(spark, sf))):
        df.write.parquet(str(root / name))
        out[name] = spark.read.parquet(str(root / name))
    return out


@pytest.fixture(scope="module")
def clean_print(clean):
    return fp.fingerprint(clean, CONTRACT).cache()


def red(clean, clean_print, table, damage):
    """Names of the failed checks and the row compare's findings after the damage."""
    target = dict(clean)
    target[table] = damage(clean[table])
    found = checks.verify(
        CONTRACT, clean, target, clean_print, fp.fingerprint(target, CONTRACT), original=clean["merchants"]
    )
    failed = {r.check_name for r in found.where(~F.col("passed")).select("check_name").distinct().collect()}
    diff = compare.row_diff(clean[table], target[table], CONTRACT.table(table)).collect()
    return failed, diff


def on(key, column, value):
    return lambda df: df.withColumn(column, F.when(F.col(df.columns[0]) == key, value).otherwise(F.col(column)).cast(df.schema[column].dataType))


def test_clean_copy_is_green(clean, clean_print):
    failed, diff = red(clean, clean_print, TXN, lambda df: df.repartition(3))
    assert failed == set() and diff == []


def test_dropped_row(clean, clean_print):
    failed, diff = red(clean, clean_print, TXN, lambda df: df.where("txn_id <> 2"))
    assert {"row_count", "money_sum", "parent_profile"} <= failed
    assert [(r.row_key, r.status) for r in diff] == [("2", "missing_in_target")]


def test_tiny_amount(clean, clean_print):
    failed, diff = red(clean, clean_print, TXN, on(5, "amount", F.expr("amount + 0.0001")))
    assert failed == {"money_sum", "parent_profile"}
    assert [(r.row_key, r.status, r.columns) for r in diff] == [("5", "changed", "amount")]


def test_swapped_parents(clean, clean_print):
    a, b = clean[TXN].where("txn_id IN (1, 2)").orderBy("txn_id").collect()
    assert a.merchant_id != b.merchant_id
    swap = lambda df: on(2, "merchant_id", F.lit(a.merchant_id))(on(1, "merchant_id", F.lit(b.merchant_id))(df))
    failed, diff = red(clean, clean_print, TXN, swap)
    assert failed == {"parent_profile"}
    assert {(r.row_key, r.columns) for r in diff} == {("1", "merchant_id"), ("2", "merchant_id")}


def test_shifted_hour(clean, clean_print):
    failed, diff = red(clean, clean_print, TXN, lambda df: df.withColumn("captured_at", F.expr("captured_at + INTERVAL 1 HOUR")))
    assert failed == {"date_range"}
    assert len(diff) == clean[TXN].count() and {r.columns for r in diff} == {"captured_at"}


def test_null_replaced(clean, clean_print):
    key = clean[TXN].where("settled_at IS NULL").agg(F.min("txn_id")).first()[0]
    middle = F.lit("1998-01-01 00:00:00").cast("timestamp")
    failed, diff = red(clean, clean_print, TXN, on(key, "settled_at", middle))
    assert failed == {"null_count"} and [(r.row_key, r.columns) for r in diff] == [(str(key), "settled_at")]


def test_case_changed(clean, clean_print):
    key = clean[TXN].where("txn_status = 'Captured'").agg(F.min("txn_id")).first()[0]
    failed, _ = red(clean, clean_print, TXN, on(key, "txn_status", F.lit("CAPTURED")))
    assert failed == {"status_count", "match_count"}
    key = clean[TXN].where("txn_status = 'captured'").agg(F.min("txn_id")).first()[0]
    failed, diff = red(clean, clean_print, TXN, on(key, "txn_status", F.lit("CAPTURED")))
    assert failed == {"status_count"} and [r.columns for r in diff] == ["txn_status"]


def test_lost_variant(clean, clean_print):
    failed, _ = red(clean, clean_print, TXN, lambda df: df.withColumn("txn_status", F.expr("replace(txn_status, 'CAPTURED', 'captured')")))
    assert failed == {"status_count", "case_variant"}


def test_unknown_parent(clean, clean_print):
    failed, _ = red(clean, clean_print, TXN, on(3, "merchant_id", F.lit(999_999)))
    assert failed == {"orphans", "parent_profile"}


def test_garbled_on_one_side(clean, clean_print):
    failed, diff = red(clean, clean_print, "merchants", on(0, "legal_name", F.lit("σîùµû╣")))
    assert failed == {"unicode_sample"} and [r.columns for r in diff] == ["legal_name"]


def test_garbled_on_both_sides_is_seen_by_the_anchor_only(clean):
    broken = dict(clean)
    broken["merchants"] = on(0, "legal_name", F.lit("σîùµû╣τë⌐µ╡ü"))(clean["merchants"])
    profile = fp.fingerprint(broken, CONTRACT)
    found = checks.verify(CONTRACT, broken, broken, profile, profile, original=clean["merchants"])
    failed = found.where(~F.col("passed")).collect()
    assert [(r.check_name, r.key, r.failure_class) for r in failed] == [("anchor", "0", 0)]


def test_next_key_below_maximum(clean, clean_print):
    top = clean[TXN].agg(F.max("txn_id")).first()[0]
    at = lambda k: checks.next_key_checks(clean_print, CONTRACT, {TXN: k}).first().passed
    assert not at(top) and at(top + 1)


def test_generated_cent(spark, clean):
    rows = add_generated(settle.derive_settlements(settle.derive_batches(clean[TXN])), pay.SETTLEMENTS)
    good = checks.generated_check(rows, pay.SETTLEMENTS)
    assert good.where(~F.col("passed")).count() == 0
    bad = rows.withColumn("gross_amount", F.expr("CAST(gross_amount + 0.01 AS DECIMAL(19,4))"))
    assert [(r.subject, r.key) for r in checks.generated_check(bad, pay.SETTLEMENTS).where(~F.col("passed")).collect()] == [("gross_amount", "wrong")]


def test_gate(clean, clean_print):
    target = dict(clean)
    target[TXN] = clean[TXN].where("txn_id <> 2")
    found = checks.verify(CONTRACT, clean, target, clean_print, fp.fingerprint(target, CONTRACT))
    with pytest.raises(checks.GateClosed, match="row_count"):
        checks.gate(found)
    key = clean[TXN].where("txn_status = 'captured'").agg(F.min("txn_id")).first()[0]
    target[TXN] = on(key, "txn_status", F.lit("CAPTURED"))(clean[TXN])
    found = checks.verify(CONTRACT, clean, target, clean_print, fp.fingerprint(target, CONTRACT))
    assert {r.check_name for r in checks.gate(found).collect()} == {"status_count"}
    assert {r.response for r in found.where("failure_class = 1").select("response").collect()} == {"fix, wipe and reload"}


def test_optional_checks_are_skipped(spark, clean):
    bare = Contract(tables=(pay.MERCHANTS, pay.TRANSACTIONS))
    profile = fp.fingerprint(clean, bare)
    found = checks.verify(bare, clean, clean, profile, profile)
    skipped = {r.check_name for r in found.where("passed IS NULL").collect()}
    assert skipped == {"match_count", "case_variant", "unicode_sample", "anchor"}
    assert checks.gate(found).count() == 0


def test_empty_unicode_sample_fails(clean):
    plain = {"merchants": clean["merchants"].where("legal_name LIKE 'Customer%'"), TXN: clean[TXN]}
    profile = fp.fingerprint(plain, CONTRACT)
    assert not checks.unicode_present(profile, CONTRACT).first().passed


def test_null_sum_is_reported_not_raised(clean, clean_print):
    failed, _ = red(clean, clean_print, TXN, lambda df: df.where("1 = 0"))
    assert {"row_count", "money_sum", "date_range"} <= failed


def test_repeated_keys_do_not_multiply(spark, clean):
    """One key holding thousands of rows on both sides costs its distinct rows, not all pairs."""
    table = pay.TRANSACTIONS
    hot = clean[TXN].where("txn_id = 7").crossJoin(spark.range(20_000)).drop("id")
    source, target = clean[TXN].unionByName(hot), clean[TXN].unionByName(hot.limit(19_998))
    assert [(r.row_key, r.status, r.only_source, r.only_target) for r in compare.row_diff(source, target, table).collect()] == [
        ("7", "repeated_key", 2, 0)
    ]


def test_narrowed_compare_agrees_with_the_whole_one(spark, sf, clean):
    copy = pay.migrated(spark, sf)
    whole = compare.row_diff(clean[TXN], copy, pay.TRANSACTIONS)
    narrow = compare.narrowed_row_diff(clean[TXN], copy, pay.TRANSACTIONS, block=50)
    assert whole.exceptAll(narrow).count() == 0 and narrow.exceptAll(whole).count() == 0


def test_checksums_see_a_value_moving_to_its_neighbour(spark, clean):
    moved = clean[TXN].withColumns({
        "auth_code": F.when((F.col("txn_id") == 20), F.lit(None)).otherwise(F.col("auth_code")),
        "card_last4": F.when((F.col("txn_id") == 20), F.col("auth_code")).otherwise(F.col("card_last4")),
    })
    assert clean[TXN].where("txn_id = 20 AND card_last4 IS NULL AND auth_code IS NOT NULL").count() == 1
    assert compare.differing_blocks(clean[TXN], moved, pay.TRANSACTIONS).count() == 1


def test_snapshot_compare(clean, clean_print):
    assert checks.snapshot_compare(clean_print, clean_print).where("NOT same").count() == 0
    other = fp.fingerprint({TXN: clean[TXN].where("txn_id > 1")}, CONTRACT)
    assert checks.snapshot_compare(clean_print, other).where("NOT same").count() > 0
