"""Hash trees, sampled hashes, one-scan fingerprints, numbering, moments, kept-up summaries, bucketed copies, confirmation."""

import random
import re
import uuid
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from proofline.contract import Column, Contract, ParentLink, Table
from proofline.operators import compare, fingerprint as fp, hash_tree, keys, settle, summary
from proofline.plans import payments as pay
from proofline.plans import queries as q
from proofline.streaming import apply, moments, pending

CODES = Table("codes", "code", (Column("code", "text"), Column("parent", "int", True), Column("amount", "money", True)), (ParentLink("parent", "codes"),))
ROWS = "code string, parent int, amount decimal(19,4)"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def codes(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def made(n):
    return [(f"k{i}", i % 7 or None, Decimal(i) / 4) for i in range(n)]


def differences(df):
    return Counter(map(tuple, df.collect()))


# -- hash trees ------------------------------------------------------------------


@pytest.mark.parametrize("most", [1 << 14, 3, 0])
def test_tree_diff_agrees_with_the_whole_compare(spark, tmp_path, most):
    rows = made(500)
    other = [r for r in rows if r[0] != "k7"]
    other[30] = (other[30][0], 99, other[30][2])
    other[31] = (other[31][0], None, None)
    other += [("new", 1, None), (None, 3, None), ("k9", 2, Decimal("2.25"))]
    rows += [(None, 3, Decimal(1)), ("twice", 1, Decimal(1)), ("twice", 1, Decimal(1))]
    one, two = codes(spark, rows), codes(spark, other)
    trees = []
    for n, df in enumerate((one, two)):
        hash_tree.write_tree(hash_tree.tree(df, CODES, 3), str(tmp_path / str(n)))
        trees.append(hash_tree.read_tree(spark, str(tmp_path / str(n))))
    got = hash_tree.hash_tree_diff(one, two, CODES, *trees, levels=3, most=most)
    assert differences(got) == differences(compare.row_diff(one, two, CODES)) and got.count() > 5


def test_equal_copies_descend_nowhere_and_move_no_rows(spark, sf):
    df = pay.merchants(spark, sf)
    table = replace(pay.MERCHANTS, key="merchant_guid")
    own, upper = hash_tree.tree(df, table), hash_tree.tree(df.withColumn("merchant_guid", F.upper("merchant_guid")), table)
    assert hash_tree.differing_ranges(own, upper) == (1, [])
    assert hash_tree.hash_tree_diff(df, df, table, own, own).count() == 0
    assert len(re.findall("FileScan", plan(own))) == 1


def test_only_rows_of_differing_ranges_are_shuffled(spark, sf):
    df = pay.merchants(spark, sf)
    other = df.withColumn("legal_name", F.when(F.col("merchant_id") == 3, "x").otherwise(F.col("legal_name")))
    level, found = hash_tree.differing_ranges(hash_tree.tree(df, pay.MERCHANTS), hash_tree.tree(other, pay.MERCHANTS))
    assert level == hash_tree.LEVELS and len(found) == 1
    text = plan(hash_tree.hash_tree_diff(df, other, pay.MERCHANTS, hash_tree.tree(df, pay.MERCHANTS), hash_tree.tree(other, pay.MERCHANTS)))
    # the filter by ranges stands below the first exchange of rows
    assert text.rindex("BroadcastHashJoin") > text.rindex("Exchange hashpartitioning") and "LeftSemi" in text


def test_empty_copies(spark):
    none = codes(spark, [])
    some = codes(spark, made(3))
    tree = lambda df: hash_tree.tree(df, CODES)
    assert hash_tree.hash_tree_diff(none, none, CODES, tree(none), tree(none)).count() == 0
    assert {r.status for r in hash_tree.hash_tree_diff(some, none, CODES, tree(some), tree(none)).collect()} == {"missing_in_target"}


def test_sampled_hashes_see_truncation(spark):
    rows = made(400)
    other = [(c, p, None if i % 5 == 0 else a) for i, (c, p, a) in enumerate(rows)]
    got = hash_tree.row_hash_sample(codes(spark, [*rows, (None, 1, None)]), codes(spark, other), CODES, 4).collect()
    wrong = {c for i, (c, _, _) in enumerate(rows) if i % 5 == 0}
    assert 50 < len(got) < 150 and all(r.same == (r.row_key not in wrong) for r in got)
    assert hash_tree.row_hash_sample(codes(spark, []), codes(spark, []), CODES, 4).count() == 0


# -- fingerprints ------------------------------------------------------------------


def test_fingerprint_takes_one_scan_of_a_table(spark, sf):
    df = fp.table_fingerprint(pay.transactions(spark, sf), pay.TRANSACTIONS, pay.PAYMENTS)
    assert len(re.findall("FileScan", plan(df))) == 1
    apart = [fp.long_form(pay.transactions(spark, sf), "transactions", fp.scalar_measures(pay.TRANSACTIONS, pay.PAYMENTS.case_check))]
    apart += fp.parent_profile(pay.transactions(spark, sf), pay.TRANSACTIONS)
    apart.append(fp.value_counts(pay.transactions(spark, sf), "transactions", "status_count", "txn_status"))
    assert differences(df) == differences(q.union(apart))


def test_fingerprint_of_an_empty_table_and_of_null_groups(spark):
    contract = Contract((Table("parents", "parent", (Column("parent", "int"),)), replace(CODES, parents=(ParentLink("parent", "parents"),))))
    none = {(r.check_name, r.key): r.value for r in fp.table_fingerprint(codes(spark, []), CODES, contract).collect()}
    assert none[("row_count", "")] == "0" and none[("null_count", "")] == "0" and not any(c == "parent_profile" for c, _ in none)
    found = fp.table_fingerprint(codes(spark, [("a", None, None), ("b", 1, Decimal(2))]), CODES, contract).where("subject = 'parent: rows'")
    assert {(r.key, r.value) for r in found.collect()} == {(None, "1"), ("1", "1")}


def test_a_null_group_is_not_the_text_null(spark):
    columns = "table_name string, check_name string, subject string, key string, value string"
    one = spark.createDataFrame([("t", "c", "s", None, "1"), ("t", "c", "s", "<null>", "2")], columns)
    assert compare.fingerprint_diff(one, one).count() == 0 and compare.fingerprint_diff(one, one, False).count() == 2


# -- numbering -----------------------------------------------------------------------


def test_numbers_follow_the_natural_key(spark):
    rows = [(i * 7919 % 1000, f"n{i % 3}") for i in range(1000)] + [(None, "z")]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = keys.allocate_keys(df, "key", ["a", "b"], above=100).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert {(r.a, r.b): r.key for r in got} == {r: 101 + n for n, r in enumerate(order)}
    assert keys.allocate_keys(df.where("false"), "key", ["a"], above=0).count() == 0
    with pytest.raises(Exception, match="not unique"):
        keys.allocate_keys(df.union(df), "key", ["a", "b"], above=0).collect()
    with pytest.raises(ValueError, match="already"):
        keys.allocate_keys(df, "a", ["b"], above=0)


# -- moments ---------------------------------------------------------------------------


def random_log(spark, seed, n=300, hot=0.4):
    r = random.Random(seed)
    base = [(k, Decimal(k), -1) for k in range(0, 30, 2)]
    log = [(0 if r.random() < hot else r.randrange(30), s, datetime(2024, 1, 1), r.choice("IUD"), Decimal(r.randrange(100))) for s in range(n)]
    return (
        spark.createDataFrame(base, "k long, amount decimal(19,4), seq long"),
        spark.createDataFrame(log, "k long, seq long, commit_ts timestamp, op string, amount decimal(19,4)"),
    )


@pytest.mark.parametrize("block", [7, 1000])
def test_many_moments_are_each_moment(spark, block):
    base, log = random_log(spark, 5)
    at = [0, 1, 17, 18, 150, 299, 5000]
    got = moments.as_of_many(base, log, ["k"], ["amount"], [*at, 17], block=block)
    assert "CartesianProduct" not in plan(got) and "NestedLoop" not in plan(got)
    found = differences(got)
    want = Counter()
    for m in at:
        want.update((m, *r) for r in map(tuple, apply.as_of(base, log, ["k"], ["amount"], m).collect()))
    assert found == want
    assert moments.as_of_many(base, log, ["k"], ["amount"], []).count() == 0
    assert moments.as_of_many(base.where("false"), log.where("false"), ["k"], ["amount"], at).count() == 0


# -- summaries kept up -------------------------------------------------------------------


def test_kept_up_summary_equals_the_recomputed_one(spark):
    r = random.Random(2)
    table = {}
    names = "txn_id long, merchant_id int, amount decimal(19,4), fee_amount decimal(19,4), txn_status string, captured_at timestamp"

    def row(i):
        at = datetime(2024, 1, r.randrange(1, 5), r.randrange(24)) if r.random() < 0.9 else None
        return (i, r.choice([1, 2, None]), Decimal(r.randrange(1000)) / 4, r.choice([None, Decimal("0.25")]), r.choice(["Captured", "CAPTURED", "Voided", None]), at)

    log = []
    for _ in range(400):
        i = r.randrange(80)
        old = table.pop(i, None)
        new = row(i) if old is None or r.random() < 0.6 else None
        if new:
            table[i] = new
        log.append((old, new))
    half = {}
    for old, new in log[:200]:
        if old:
            half.pop(old[0])
        if new:
            half[new[0]] = new
    whole = lambda t: spark.createDataFrame(list(t.values()), names).where(
        "lower(txn_status) = 'captured' and captured_at is not null"
    ).groupBy(F.to_date("captured_at").alias("summary_date"), "merchant_id").agg(*settle.totals())
    image = f"struct<{', '.join(': '.join(p.split(' ')) for p in names.split(', '))}>"
    rest = spark.createDataFrame(log[200:], f"old {image}, new {image}")
    got = summary.maintain(whole(half), rest)
    assert differences(got) == differences(whole(table).select(*got.columns))
    assert "FileScan" not in plan(got)
    assert differences(summary.maintain(whole(half), rest.where("false"))) == differences(whole(half).select(*got.columns))
    out = rest.where("old is not null").select("old", F.lit(None).cast(image).alias("new"))
    with pytest.raises(Exception, match="more rows than the summary"):
        summary.maintain(whole({}), out).collect()


# -- bucketed copies ---------------------------------------------------------------------


def test_bucketed_copies_meet_without_an_exchange(spark):
    rows = made(300)
    other = [r for r in rows if r[0] != "k8"] + [("more", 1, None)]
    other[3] = (other[3][0], 50, None)
    twice = [("t", 1, Decimal(1)), ("t", 2, Decimal(2))]
    one = compare.store_bucketed(codes(spark, rows + twice), CODES, "one_" + uuid.uuid4().hex, 4)
    two = compare.store_bucketed(codes(spark, other + twice[::-1]), CODES, "two_" + uuid.uuid4().hex, 4)
    found = compare.bucketed_row_diff(one, two, CODES)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(compare.bucketed_row_diff(one, two, CODES))
        assert differences(found) == differences(compare.row_diff(codes(spark, rows + twice), codes(spark, other + twice[::-1]), CODES))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


# -- confirmation --------------------------------------------------------------------------


def test_unresolved_mismatches_on_a_batch(spark):
    at = datetime(2024, 1, 1)
    minute = lambda n: at + timedelta(minutes=n)
    wrong = spark.createDataFrame([(1, minute(0)), (2, minute(0)), (2, minute(9)), (3, minute(0)), (None, minute(1))], "k long, seen_at timestamp")
    right = spark.createDataFrame([(1, minute(5)), (2, minute(6)), (3, minute(-1)), (None, minute(2)), (1, minute(3))], "k long, matched_at timestamp")
    got = pending.unresolved(wrong, right, ["k"], 300)
    assert {(r.k, r.seen_at) for r in got.collect()} == {(2, minute(0)), (2, minute(9)), (3, minute(0)), (None, minute(1))}
    assert pending.unresolved(wrong.where("false"), right, ["k"], 300).count() == 0
    assert pending.unresolved(wrong, right.where("false"), ["k"], 300).count() == 5
