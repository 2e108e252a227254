"""Every query the package registers: name -> function of (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.contract import Contract
from proofline.functions import conform as C
from proofline.functions import naming, predicates as P
from proofline.operators import checks, compare, hash_tree, keys, orphans, settle, summary
from proofline.operators import fingerprint as fp
from proofline.operators.projections import assert_published, project, publish
from proofline.plans import payments as pay
from proofline.plans import sql_functions
from proofline.session import prepare, scratch
from proofline.sources import delimited, export, tables
from proofline.streaming import apply, cutover, feed, history, moments, pending
from proofline.streaming.replica import Replica

Query = Callable[[SparkSession, str], DataFrame]

# Fixed points of the registered queries.
AS_OF = datetime(2001, 8, 1)
RANGE = (datetime(2001, 3, 1), datetime(2001, 4, 1))
REPORT_DAYS = 365
SUMMARY_DAYS = 90
SUMMARY_AS_OF = datetime(2001, 7, 31, 6, 15)
EXPORT_DAYS = 30
AS_OF_SEQ = 6000
NEXT_KEY = 10_001
ZONE = "America/New_York"
TEXT_PATTERNS = ("%é%", "%ñ%", "%ü%")
KEY_BLOCK = 10_000
SAMPLE_EVERY = 16
FEED_PARTS = 5
COPY_BUCKETS = 8
MARKED_KEY = 2 * pay.NEW_KEYS
MOMENTS = (0, 5, 250, 999, 1000, 2500, 6000, 6001, 90_000, 10_000_000)
ERROR_LIMIT = 100
MAX_LAG = 3.0
SEEN_AT = datetime(2024, 1, 1, 12, 0)

_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
    return fn


def registered() -> dict[str, Query]:
    return dict(_queries)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def four_tables(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every table of the contract, parents first; batches and settlements come from the original transactions."""
    made = numbered_batches(spark, sf_dir)
    paid = C.add_generated(settle.derive_settlements(made, ["batch_id"]), pay.SETTLEMENTS)
    return {
        "merchants": pay.merchants(spark, sf_dir),
        "transactions": pay.transactions(spark, sf_dir) if rows is None else rows,
        "batches": made,
        "settlements": keys.allocate_keys(paid, "settlement_id", ["batch_id"], above=0),
    }


def measured(spark: SparkSession, sf_dir: str, check: str) -> DataFrame:
    """One check of the fingerprint over all four tables, reading only its columns."""
    parts = []
    for name, df in four_tables(spark, sf_dir).items():
        wanted = [m for m in fp.scalar_measures(pay.PAYMENTS.table(name), None) if m[0] == check]
        if wanted:
            parts.append(fp.long_form(df, name, wanted))
    return union(parts)


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle.derive_batches(pay.transactions(spark, sf_dir))


def numbered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.allocate_keys(batches(spark, sf_dir), "batch_id", ["merchant_id", "batch_date"], above=0)


# -- fingerprint -------------------------------------------------------------


@query
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = batches(spark, sf_dir)
    frames = {
        "merchants": pay.merchants(spark, sf_dir),
        "transactions": pay.transactions(spark, sf_dir),
        "batches": made,
        "settlements": settle.derive_settlements(made),
    }
    return union([df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n, df in frames.items()])


@query
def money_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark, sf_dir, "money_sum").select("table_name", "subject", F.col("value").cast("decimal(38,4)").alias("total"))


@query
def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark, sf_dir, "date_range").select("table_name", "subject", "key", F.col("value").cast("timestamp").alias("bound"))


@query
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark, sf_dir, "null_count").select("table_name", "subject", F.col("value").cast("bigint").alias("null_rows"))


@query
def key_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark, sf_dir, "max_key").select("table_name", "subject", F.col("value").cast("bigint").alias("max_key"))


@query
def next_key_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.next_key_status(pay.transactions(spark, sf_dir), "transactions", "txn_id", NEXT_KEY)


@query
def parent_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and money per parent over all three edges."""
    frames = four_tables(spark, sf_dir)
    return union([part for name, df in frames.items() for part in fp.parent_profile(df, pay.PAYMENTS.table(name))])


@query
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = fp.value_counts(pay.transactions(spark, sf_dir), "transactions", "status_count", "txn_status")
    return counts.select(F.col("key").alias("txn_status"), F.col("value").cast("bigint").alias("txn_count"))


@query
def match_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp.match_loss(pay.transactions(spark, sf_dir), "txn_status", settle.CAPTURED)


@query
def case_merged_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp.case_groups(pay.transactions(spark, sf_dir), "txn_status")


@query
def unicode_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as a multiset; their digests travel through the shuffle."""
    hits = pay.read(spark, sf_dir, "documents").where(P.any_like(F.col("text"), TEXT_PATTERNS))
    return hits.groupBy(F.sha2("text", 256).alias("text_sha256"), F.length("text").cast("bigint").alias("chars")).agg(
        F.count(F.lit(1)).alias("copies")
    )


@query
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp.fingerprint(four_tables(spark, sf_dir), pay.PAYMENTS)


@query
def fingerprint_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_fingerprint(spark, four_tables(spark, sf_dir), pay.PAYMENTS)


def written_fingerprint(spark: SparkSession, frames: dict[str, DataFrame], contract: Contract) -> DataFrame:
    """A fingerprint written once, so that every check reads it instead of the tables."""
    path = scratch(spark, "fingerprint")
    fp.write_fingerprint(fp.fingerprint(frames, contract), path)
    return spark.read.schema(", ".join(f"{c} string" for c in fp.FINGERPRINT)).json(path)


# -- settlement --------------------------------------------------------------


@query
def settlement_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle.settlement_range(pay.transactions(spark, sf_dir, *RANGE), *RANGE)


def _daily(spark: SparkSession, sf_dir: str, match: str) -> DataFrame:
    lo = P.calendar_start(AS_OF, REPORT_DAYS)
    rows, named = pay.transactions(spark, sf_dir, lo), pay.merchants(spark, sf_dir)
    return settle.report_order(settle.daily_settlement(rows, named, AS_OF, REPORT_DAYS, match))


@query
def daily_settlement_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir, "exact")


@query
def daily_settlement_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir, "folded")


@query
def daily_settlement_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over all of history: the full scan."""
    rows, named = pay.transactions(spark, sf_dir), pay.merchants(spark, sf_dir)
    return settle.daily_settlement(rows, named, None, None, "folded")


@query
def daily_settlement_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report called from SQL."""
    sql_functions.register(spark, {"merchants": pay.merchants(spark, sf_dir), "transactions": pay.transactions(spark, sf_dir)})
    return spark.sql(f"SELECT * FROM daily_settlement_summary(TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}', {REPORT_DAYS}, true)")


@query
def reconcile_orphans_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation called from SQL: three zeros over whole tables, but for the planted copy's orphans."""
    made = numbered_batches(spark, sf_dir)
    frames = {
        "merchants": pay.merchants(spark, sf_dir),
        "transactions": pay.migrated(spark, sf_dir),
        "batches": made,
        "settlements": settle.derive_settlements(made, ["batch_id"]),
    }
    sql_functions.register(spark, frames)
    return spark.sql("SELECT * FROM reconcile_orphans()")


@query
def daily_summary_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = P.calendar_start(SUMMARY_AS_OF, SUMMARY_DAYS)
    return summary.daily_summary(pay.transactions(spark, sf_dir, lo), SUMMARY_AS_OF, SUMMARY_DAYS)


@query
def rolling_and_calendar_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same number of days, counted back from the moment and from its midnight."""
    at = F.col("captured_at")
    return pay.transactions(spark, sf_dir, P.calendar_start(SUMMARY_AS_OF, SUMMARY_DAYS)).agg(
        F.count_if(P.rolling_window(at, SUMMARY_AS_OF, SUMMARY_DAYS)).alias("rolling_rows"),
        F.count_if(P.calendar_window(at, SUMMARY_AS_OF, SUMMARY_DAYS)).alias("calendar_rows"),
    )


@query
def summary_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old summary of exact matches, replaced where the folded summary has rows."""
    rows = pay.transactions(spark, sf_dir)
    old = summary.daily_summary(rows, SUMMARY_AS_OF, 2 * SUMMARY_DAYS, "exact")
    new = summary.daily_summary(rows, SUMMARY_AS_OF, SUMMARY_DAYS, "folded")
    return summary.upsert(old, new, summary.KEYS)


@query
def summary_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job run three times over overlapping windows; the last run repeats the second."""
    job = summary.SummaryTable(spark, scratch(spark, "summary"))
    rows = pay.transactions(spark, sf_dir)
    for days in (2 * SUMMARY_DAYS, SUMMARY_DAYS, SUMMARY_DAYS):
        job.run(rows, SUMMARY_AS_OF, days)
    total = "decimal(38,4)"
    return job.read().select(
        *summary.KEYS, "txn_count", *[F.col(c).cast(total).alias(c) for c in ("gross_amount", "total_fees", "net_amount")]
    )


@query
def summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole summary, led from the original transactions to the damaged copy by the changes between them alone."""
    before, after = pay.transactions(spark, sf_dir), pay.migrated(spark, sf_dir)
    names = pay.TRANSACTIONS.names()
    image = lambda df, name: df.select("txn_id", F.struct(*names).alias(name))
    log = image(before, "old").join(image(after, "new"), "txn_id", "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    start = before.where(P.matches(F.col("txn_status"), settle.CAPTURED, "folded")).groupBy(
        F.to_date("captured_at").alias("summary_date"), "merchant_id"
    ).agg(*settle.totals())
    return summary.maintain(start, log)


@query
def summary_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failed run leaves its line, the error goes on to the caller, and the next run succeeds."""
    job = summary.SummaryTable(spark, scratch(spark, "summary"))
    rows = pay.transactions(spark, sf_dir)
    try:
        job.run(rows.withColumn("amount", F.raise_error(F.lit("planted failure")).cast("decimal(19,4)")), SUMMARY_AS_OF, SUMMARY_DAYS)
    except Exception:  # the planted one; its log line is what this query shows
        pass
    job.run(rows, SUMMARY_AS_OF, SUMMARY_DAYS)
    return job.log.runs().select(
        "job_name", "status", "rows_written", F.col("error").isNotNull().alias("has_error"), F.col("finished_at").isNotNull().alias("finished")
    )


@query
def derive_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches(spark, sf_dir)


@query
def derive_settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle.derive_settlements(batches(spark, sf_dir))


@query
def generated_gross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generated gross beside the batch's own, at most 0.0001 apart."""
    made = batches(spark, sf_dir)
    rows = C.add_generated(settle.derive_settlements(made), pay.SETTLEMENTS)
    own = made.select("merchant_id", "batch_date", F.col("gross_amount").alias("batch_gross"))
    return rows.join(own, ["merchant_id", "batch_date"]).select(
        "merchant_id", "batch_date", F.col("gross_amount").cast("decimal(38,4)").alias("gross_amount"),
        (F.col("gross_amount") - F.col("batch_gross")).cast("decimal(38,4)").alias("rounding"),
    )


@query
def generated_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check over a copy with one cent added to some generated values."""
    rows = C.add_generated(settle.derive_settlements(batches(spark, sf_dir)), pay.SETTLEMENTS)
    off = F.when(F.col("merchant_id") % 50 == 3, F.lit("0.01")).otherwise("0").cast("decimal(19,4)")
    damaged = rows.withColumn("gross_amount", (F.col("gross_amount") + off).cast("decimal(19,4)"))
    return checks.generated_check(damaged, pay.SETTLEMENTS).select(
        "check_name", "failure_class", "subject", "key", F.col("target_value").cast("bigint").alias("rows"), "passed"
    )


@query
def allocate_batch_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New keys above the high-water mark, in the order of merchant and day: dense, none reused."""
    above = keys.high_water(pay.merchants(spark, sf_dir), "merchant_id")
    return keys.allocate_keys(batches(spark, sf_dir).select("merchant_id", "batch_date"), "batch_id", ["merchant_id", "batch_date"], above)


# -- comparing copies ----------------------------------------------------------


@query
def reconcile_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three edges, over a copy in which parents are missing."""
    made = numbered_batches(spark, sf_dir)
    frames = {
        "merchants": pay.merchants(spark, sf_dir).where("merchant_id % 100 <> 1"),
        "transactions": pay.migrated(spark, sf_dir),
        "batches": made.where("merchant_id % 101 <> 3"),
        "settlements": settle.derive_settlements(made, ["batch_id"]),
    }
    return orphans.reconcile_orphans(pay.PAYMENTS, frames)


@query
def profile_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = {"transactions": pay.transactions(spark, sf_dir)}
    other = {"transactions": pay.migrated(spark, sf_dir)}
    return compare.fingerprint_diff(fp.fingerprint(one, pay.PAYMENTS), fp.fingerprint(other, pay.PAYMENTS)).drop("same")


@query
def row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.row_diff(pay.transactions(spark, sf_dir), pay.migrated(spark, sf_dir), pay.TRANSACTIONS)


@query
def row_diff_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same differences, comparing only key blocks whose checksums differ."""
    return compare.narrowed_row_diff(pay.transactions(spark, sf_dir), pay.migrated(spark, sf_dir), pay.TRANSACTIONS, KEY_BLOCK)


@query
def hash_tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants by their identifier against a copy, through written trees of digests."""
    table = replace(pay.MERCHANTS, key="merchant_guid")
    frames = pay.merchants(spark, sf_dir), pay.copied_merchants(spark, sf_dir)
    trees = []
    for df in frames:
        path = scratch(spark, "tree")
        hash_tree.write_tree(hash_tree.tree(df, table), path)
        trees.append(hash_tree.read_tree(spark, path))
    return hash_tree.hash_tree_diff(*frames, table, *trees)


@query
def row_diff_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row compare over copies stored in buckets of the key: no row moves when they meet."""
    stored = []
    for df in (pay.transactions(spark, sf_dir), pay.migrated(spark, sf_dir)):
        stored.append(compare.store_bucketed(df, pay.TRANSACTIONS, "copy_" + scratch(spark, "t").rsplit("-", 1)[-1], COPY_BUCKETS))
    return compare.bucketed_row_diff(*stored, pay.TRANSACTIONS)


@query
def row_hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.row_hash_sample(pay.transactions(spark, sf_dir), pay.migrated(spark, sf_dir), pay.TRANSACTIONS, SAMPLE_EVERY)


@query
def key_set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.key_set_diff(pay.transactions(spark, sf_dir), pay.migrated(spark, sf_dir), "txn_id")


@query
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.block_checksums(pay.transactions(spark, sf_dir), pay.TRANSACTIONS, KEY_BLOCK).drop("checksum")


@query
def differing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.differing_blocks(pay.transactions(spark, sf_dir), pay.migrated(spark, sf_dir), pay.TRANSACTIONS, 100)


@query
def anchor_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded names against their file: some are misread, one key in 211 is missing."""
    original = pay.merchants(spark, sf_dir)
    loaded = original.where("merchant_id % 211 <> 2").withColumn("legal_name", F.expr("replace(legal_name, '北方物流', 'σîùµû╣τë⌐µ╡ü')"))
    return compare.anchor_diff(original, loaded, pay.MERCHANTS, "legal_name")


@query
def snapshot_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = fp.fingerprint({"transactions": pay.migrated(spark, sf_dir)}, pay.PAYMENTS)
    return checks.snapshot_compare(one, fp.fingerprint({"transactions": pay.transactions(spark, sf_dir)}, pay.PAYMENTS))


@query
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = fp.fingerprint({"transactions": pay.transactions(spark, sf_dir)}, pay.PAYMENTS)
    return checks.side_by_side(one, fp.fingerprint({"transactions": pay.migrated(spark, sf_dir)}, pay.PAYMENTS))


def verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks over the four tables of both sides.

    Both sides hold names that were misread from the original file, so only the anchor sees
    them; the copy's transactions have the planted differences and some of its batches are missing.
    """
    source = four_tables(spark, sf_dir)
    path = scratch(spark, "original")
    write_delimited(source["merchants"].withColumn("is_active", F.col("is_active").cast("int")), path)
    original = C.accepted(C.conform(delimited.read_delimited(spark, path, pay.MERCHANTS), pay.MERCHANTS))
    source["merchants"] = source["merchants"].withColumn("legal_name", F.expr(pay.MISREAD_NAME))
    target = {**source, "transactions": pay.migrated(spark, sf_dir), "batches": source["batches"].where(pay.BATCH_FILTER)}
    return checks.verify(
        pay.PAYMENTS, source, target,
        written_fingerprint(spark, source, pay.PAYMENTS), written_fingerprint(spark, target, pay.PAYMENTS),
        original=original, next_keys={"transactions": NEXT_KEY},
    )


@query
def verification_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(spark, sf_dir)


@query
def verification_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.summary(verified(spark, sf_dir))


@query
def case_variants_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fp.fingerprint({"transactions": pay.migrated(spark, sf_dir)}, pay.PAYMENTS)
    return checks.variant_checks(found, pay.PAYMENTS).select("key", F.col("target_value").cast("bigint").alias("rows"), "passed")


@query
def failure_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the differences of the planted copy call for."""
    one = fp.fingerprint({"transactions": pay.transactions(spark, sf_dir)}, pay.PAYMENTS)
    found = checks.fingerprint_checks(one, fp.fingerprint({"transactions": pay.migrated(spark, sf_dir)}, pay.PAYMENTS))
    return found.where(~F.col("passed")).groupBy("failure_class", "response").agg(F.count(F.lit(1)).alias("failed_rows"))


# -- filters and conversions ---------------------------------------------------


@query
def equality_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One literal under every equality; padding is added so that it shows."""
    rows = pay.transactions(spark, sf_dir).select(
        F.expr("CASE WHEN txn_id % 2 = 0 THEN txn_status || '  ' ELSE txn_status END").alias("s")
    )
    s = F.col("s")
    return rows.agg(
        F.count_if(P.exact(s, "Captured")).alias("exact_rows"),
        F.count_if(P.folded(s, "Captured")).alias("folded_rows"),
        F.count_if(P.collation_equal(s, "Captured")).alias("collated_rows"),
        F.count_if(P.case_sensitive_equal(F.collate(s, P.FOLDED_TRIMMED), "Captured")).alias("forced_exact_rows"),
        F.count_if(C.trimmed(s) == "Captured").alias("trimmed_rows"),
    )


@query
def collation_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay.transactions(spark, sf_dir).where(P.collation_equal(F.col("txn_status"), "CAPTURED ")).select("txn_id", "txn_status", "amount")


@query
def char_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded codes: stored as read, equal without their padding."""
    padded = pay.transactions(spark, sf_dir).select(F.rpad("currency", 6, " ").alias("currency"), "amount")
    return padded.groupBy(C.trimmed(F.col("currency")).alias("currency")).agg(
        F.count(F.lit(1)).alias("txn_count"), F.count_if(C.trimmed(F.col("currency")) == "USD").alias("usd_rows")
    )


@query
def timestamp_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture times read as New York wall clock."""
    rows = pay.transactions(spark, sf_dir)
    return rows.select("txn_id", C.attach_zone(F.col("captured_at"), ZONE).alias("captured_utc"))


@query
def computed_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pay.transactions(spark, sf_dir).withColumn("fee_amount", F.when(F.col("txn_id") % 10 != 0, F.col("fee_amount")))
    return rows.agg(
        F.sum(settle.fee_or_zero()).cast("decimal(38,4)").alias("fees"), F.sum(settle.net_of_fee()).cast("decimal(38,4)").alias("net")
    )


@query
def conformed_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.accepted(C.conform(raw_merchants(spark, sf_dir), pay.MERCHANTS))


@query
def conformed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.accepted(C.conform(raw_transactions(spark, sf_dir), pay.TRANSACTIONS))


@query
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.rejects(C.conform(raw_merchants(spark, sf_dir), pay.MERCHANTS), pay.MERCHANTS).unionByName(
        C.rejects(C.conform(raw_transactions(spark, sf_dir), pay.TRANSACTIONS), pay.TRANSACTIONS)
    )


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay.merchants(spark, sf_dir).selectExpr(*pay.select_list(pay.RAW_MERCHANT_COLUMNS))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay.transactions(spark, sf_dir).selectExpr(*pay.select_list(pay.RAW_TRANSACTION_COLUMNS))


@query
def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-case names lower-cased by the mapping rules."""
    rules = [naming.RenameRule("schema", "rename", "dbo", "public"), naming.RenameRule("column", "convert-lowercase")]
    shouted = pay.transactions(spark, sf_dir)
    shouted = shouted.toDF(*[c.upper() for c in shouted.columns])
    return naming.rename_columns(shouted, rules).select("txn_id", "merchant_id", "amount")


# Rules for the four tables as their source names them: some apply, some must not.
MAPPING = {
    "rules": [
        {"rule-type": "selection", "rule-id": "1", "object-locator": {"schema-name": "dbo", "table-name": "%"}, "rule-action": "include"},
        {"rule-type": "selection", "rule-id": "2", "object-locator": {"schema-name": "dbo", "table-name": "SETTLE%"}, "rule-action": "exclude"},
        {"rule-type": "selection", "rule-id": "3", "object-locator": {"schema-name": "archive", "table-name": "%"}, "rule-action": "exclude"},
        {"rule-type": "transformation", "rule-id": "4", "rule-target": "schema", "object-locator": {"schema-name": "dbo"}, "rule-action": "rename", "value": "public"},
        {"rule-type": "transformation", "rule-id": "5", "rule-target": "table", "object-locator": {"schema-name": "dbo"}, "rule-action": "convert-lowercase"},
        {"rule-type": "transformation", "rule-id": "6", "rule-target": "column", "object-locator": {"schema-name": "dbo"}, "rule-action": "convert-lowercase"},
        {"rule-type": "transformation", "rule-id": "7", "rule-target": "column", "object-locator": {"schema-name": "dbo", "table-name": "TRANS%", "column-name": "AMOUNT"}, "rule-action": "rename", "value": "gross_amount"},
        {"rule-type": "transformation", "rule-id": "8", "rule-target": "column", "object-locator": {"schema-name": "dbo", "table-name": "BATCHES", "column-name": "TXN_ID"}, "rule-action": "rename", "value": "wrong"},
        {"rule-type": "transformation", "rule-id": "9", "rule-target": "column", "object-locator": {"schema-name": "archive", "column-name": "MERCHANT_ID"}, "rule-action": "rename", "value": "wrong"},
    ]
}


def mapped_tables(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str], DataFrame]:
    shouted = {n.upper(): df.toDF(*[c.upper() for c in df.columns]) for n, df in four_tables(spark, sf_dir).items()}
    return naming.Mapping.from_dict(MAPPING).apply("dbo", shouted)


@query
def selected_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table the mapping takes, under its new name."""
    taken = mapped_tables(spark, sf_dir).items()
    return union([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"), "rows") for (s, t), df in taken])


@query
def mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns renamed by the most specific rule; rules of other tables and schemas do not act."""
    return mapped_tables(spark, sf_dir)["public", "transactions"].select("txn_id", "merchant_id", "gross_amount")


@query
def new_guids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants without an identifier get one; none is used twice."""
    some = pay.merchants(spark, sf_dir).withColumn("merchant_guid", F.when(F.col("merchant_id") % 3 == 0, F.col("merchant_guid")))
    made = keys.with_new_guids(some, "merchant_guid", ["merchant_id", "legal_name"])
    return made.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("merchant_guid").alias("guids"),
        F.count_if(F.col("merchant_guid").rlike(C.UUID_TEXT)).alias("well_formed"),
    )


@query
def service_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every published view and how many rows and columns it shows."""
    frames = {"merchants": pay.merchants(spark, sf_dir), "transactions": pay.transactions(spark, sf_dir)}
    views = publish(pay.PAYMENTS, frames)
    return union([
        spark.table(n).agg(F.lit(n).alias("view_name"), F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))
        for n, df in views.items()
    ])


@query
def merchant_public(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project(pay.merchants(spark, sf_dir), pay.PUBLIC_MERCHANT)
    assert_published(rows, pay.PUBLIC_MERCHANT)
    return rows


# -- sources and sinks -----------------------------------------------------------


def write_delimited(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Fields joined by pipes, unquoted, empty for NULL: the layout the reader expects."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    options = {"sep": "|", "quote": "", "escape": "", "emptyValue": "", "nullValue": "", "encoding": encoding}
    text.write.options(**options).csv(path)


@query
def delimited_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "psv")
    write_delimited(raw_transactions(spark, sf_dir), path)
    return C.accepted(C.conform(delimited.read_delimited(spark, path, pay.TRANSACTIONS), pay.TRANSACTIONS))


@query
def utf16_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "psv16")
    write_delimited(raw_merchants(spark, sf_dir), path, "UTF-16")
    return C.accepted(C.conform(delimited.read_delimited(spark, path, pay.MERCHANTS, "UTF-16"), pay.MERCHANTS))


def refreshed(spark: SparkSession, sf_dir: str, times: int = 1) -> tuple[str, list[tables.LoadReport]]:
    root = scratch(spark, "load")
    frames = {"merchants": raw_merchants(spark, sf_dir), "transactions": raw_transactions(spark, sf_dir)}
    for _ in range(times):
        reports = tables.full_refresh(spark, pay.PAYMENTS, frames, root)
    return root, reports


@query
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice: the second load replaces the first."""
    root, _ = refreshed(spark, sf_dir, times=2)
    return union([
        tables.read_loaded(spark, pay.PAYMENTS, root, t.name).agg(F.lit(t.name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.sum(t.key).cast("bigint").alias("key_sum"))
        for t in (pay.MERCHANTS, pay.TRANSACTIONS)
    ])


@query
def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = refreshed(spark, sf_dir)
    return union([tables.read_rejects(spark, pay.PAYMENTS, root, n) for n in ("merchants", "transactions")])


@query
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, reports = refreshed(spark, sf_dir)
    return tables.loaded_metrics(reports, spark).select("table_name", "rows", "rejected", "state", (F.col("rows_per_second") > 0).alias("timed"))


@query
def clustered_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settlement range over a copy laid out by capture time."""
    path = scratch(spark, "clustered")
    tables.clustered(pay.transactions(spark, sf_dir), "captured_at", "txn_id").write.parquet(path)
    return settle.settlement_range(spark.read.parquet(path), *RANGE)


@query
def capture_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.capture_days(pay.transactions(spark, sf_dir))


@query
def latest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.latest_days(pay.transactions(spark, sf_dir), EXPORT_DAYS)


@query
def partitioned_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days exported, the latest ones exported again, everything read back."""
    path = scratch(spark, "export")
    rows = pay.transactions(spark, sf_dir)
    export.export_by_day(rows, path)
    export.export_by_day(rows, path, days=EXPORT_DAYS)
    return export.read_export(spark, path)


@query
def export_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "export")
    export.export_by_day(pay.transactions(spark, sf_dir), path, days=EXPORT_DAYS)
    return export.export_metrics(spark, path).select("capture_date", "rows", (F.col("bytes") > 0).alias("has_bytes"))


@query
def export_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "export")
    export.export_by_day(pay.transactions(spark, sf_dir), path)
    return export.read_export(spark, path, "2001-03-01", "2001-03-31").groupBy("capture_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("decimal(38,4)").alias("gross")
    )


LARGE_BATCH = 400000


@query
def export_of_large_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported rows of the days that have a large batch; other days' folders are not read."""
    path = scratch(spark, "export")
    export.export_by_day(pay.transactions(spark, sf_dir), path)
    days = batches(spark, sf_dir).where(f"gross_amount >= {LARGE_BATCH}").select(F.col("batch_date").alias(export.DAY))
    return export.read_export_days(spark, path, days)


# -- replication -----------------------------------------------------------------


def applied(spark: SparkSession, sf_dir: str) -> apply.Applied:
    return apply.apply_changes(pay.accounts(spark, sf_dir), pay.changes(spark, sf_dir), ["k"], ["amount"], block=KEY_BLOCK)


@query
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(spark, sf_dir).state


@query
def apply_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(spark, sf_dir).errors


@query
def load_conflicts_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts when the full load ended in the middle of the log."""
    judged = apply.judge(pay.changes(spark, sf_dir), pay.accounts(spark, sf_dir), ["k"], load_end=AS_OF_SEQ, block=KEY_BLOCK)
    return judged.groupBy("op", "verdict").agg(F.count(F.lit(1)).alias("changes"))


@query
def as_of_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.as_of(pay.accounts(spark, sf_dir), pay.changes(spark, sf_dir), ["k"], ["amount"], AS_OF_SEQ)


@query
def as_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts at ten positions of the log, from one pass over it."""
    return moments.as_of_many(pay.accounts(spark, sf_dir), pay.changes(spark, sf_dir), ["k"], ["amount"], list(MOMENTS), block=KEY_BLOCK)


@query
def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.table_stats(applied(spark, sf_dir).judged)


@query
def replication_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables: accounts followed by the log, transactions loaded but damaged."""
    base, rows = pay.accounts(spark, sf_dir), pay.transactions(spark, sf_dir)
    loaded = union([
        base.agg(F.lit("accounts").alias("table_name"), F.count(F.lit(1)).alias("full_load_rows")),
        rows.agg(F.lit("transactions").alias("table_name"), F.count(F.lit(1)).alias("full_load_rows")),
    ])
    stats = apply.table_stats(applied(spark, sf_dir).judged.withColumn("table_name", F.lit("accounts")), ["table_name"])
    return apply.table_report(loaded, stats, compare.row_diff(rows, pay.migrated(spark, sf_dir), pay.TRANSACTIONS))


@query
def error_escalation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors per hundred keys against a limit, each hundred standing for a table."""
    per = applied(spark, sf_dir).errors.groupBy(P.whole_blocks(F.col("k"), 100).cast("string").alias("table_name")).agg(F.count(F.lit(1)).alias("errors"))
    return apply.escalate(per, ERROR_LIMIT, tables=1)


@query
def change_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.change_history(pay.changes(spark, sf_dir))


@query
def replication_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of a poll every three seconds: a change arrives with the next poll."""
    rows = pay.changes(spark, sf_dir)
    poll = (P.whole_blocks(F.unix_micros("commit_ts"), 3_000_000) + 1) * 3_000_000
    arrived = rows.withColumn("applied_ts", F.timestamp_micros(poll.cast("bigint")))
    return history.replication_lag(arrived, by=["op"])


@query
def coverage_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only transactions and merchants are in the log."""
    log = pay.changes(spark, sf_dir).select(F.expr("CASE WHEN k % 2 = 0 THEN 'merchants' ELSE 'transactions' END").alias("table_name"))
    return cutover.coverage_gap(spark, pay.PAYMENTS, log)


@query
def pending_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that differ between the state and the base, first seen at the key's last change."""
    done = applied(spark, sf_dir).state.select("k", "amount")
    base = pay.accounts(spark, sf_dir).select("k", F.col("amount").alias("was"))
    differs = base.join(done, "k", "left").where(~F.col("amount").eqNullSafe(F.col("was")))
    first = pay.changes(spark, sf_dir).where("op <> 'U'").groupBy("k").agg(F.min("commit_ts").alias("first_seen"))
    return pending.confirm(first, differs, SEEN_AT, ["k"])


def written_stream(stream: DataFrame, path: str):
    """The finished run of a stream that appends to a table."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint")
    run = writer.trigger(availableNow=True).start()
    run.awaitTermination()
    return run


@query
def confirmed_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes stand for rows found different, inserts for rows found equal again; the log runs as a stream in several batches."""
    found = []
    for state, after in (("confirmed", pending.REPORT_AFTER), ("suspended", pending.SUSPEND_AFTER)):
        path = scratch(spark, "confirmed")
        log = feed.replay(pay.changes(spark, sf_dir), f"{path}/log", FEED_PARTS)
        wrong = log.where("op = 'D'").select("k", F.col("commit_ts").alias("seen_at"))
        right = log.where("op = 'I'").select("k", F.col("commit_ts").alias("matched_at"))
        written_stream(pending.unresolved(wrong, right, ["k"], after), path)
        found.append(spark.read.schema("k long, seen_at timestamp").parquet(f"{path}/rows").withColumn("state", F.lit(state)))
    return union(found)


@query
def stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream said about each of its batches while it ran."""
    path = scratch(spark, "status")
    run = written_stream(feed.watched(feed.replay(pay.changes(spark, sf_dir), f"{path}/log", FEED_PARTS)), path)
    return feed.status(spark, run)


@query
def cutover_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = fp.fingerprint({"transactions": pay.transactions(spark, sf_dir)}, pay.PAYMENTS)
    found = checks.fingerprint_checks(one, fp.fingerprint({"transactions": pay.migrated(spark, sf_dir)}, pay.PAYMENTS))
    return cutover.cutover_gate(replication_lag(spark, sf_dir), found, coverage_gap(spark, sf_dir), MAX_LAG)


@query
def arrival_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marked row with four decimals, written after the load, found in the state."""
    log = pay.changes(spark, sf_dir)
    mark = Decimal("4321.4321")
    marked = log.agg(F.lit(MARKED_KEY).alias("k"), (F.max("seq") + 1).alias("seq"), F.max("commit_ts").alias("commit_ts")).select(
        "k", "seq", "commit_ts", F.lit("I").alias("op"), F.lit(mark).cast("decimal(19,4)").alias("amount")
    )
    state = apply.apply_changes(pay.accounts(spark, sf_dir), log.unionByName(marked), ["k"], ["amount"], block=KEY_BLOCK).state
    newest = state.where(F.col("k") == MARKED_KEY)
    return cutover.prove_arrival(newest, {}, {"amount": mark})


EVENT_FILE = {"pathGlobFilter": "events.parquet"}


def change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = pay.read(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).options(**EVENT_FILE).parquet(sf_dir).selectExpr(*pay.select_list(pay.CHANGE_COLUMNS))


@query
def replicate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load, then the change stream, then a compaction: the batch's state again."""
    path = scratch(spark, "replica")
    rows = T.StructType([T.StructField("k", T.LongType()), T.StructField("amount", T.DecimalType(19, 4))])
    replica = Replica(spark, path, "accounts", rows, ["k"])
    replica.load(pay.accounts(spark, sf_dir), seq=-1)
    replica.follow(change_stream(spark, sf_dir), f"{path}/checkpoint").awaitTermination()
    replica.compact()
    return replica.state()


def new_replica(spark: SparkSession, sf_dir: str, error_limit: int = 0) -> Replica:
    rows = T.StructType([T.StructField("k", T.LongType()), T.StructField("amount", T.DecimalType(19, 4))])
    replica = Replica(spark, scratch(spark, "replica"), "accounts", rows, ["k"], error_limit)
    replica.load(pay.accounts(spark, sf_dir), seq=-1)
    return replica


DISORDERED: dict[tuple[str, str], Replica] = {}  # one a session and folder: three queries read the same written tables


def disordered_replica(spark: SparkSession, sf_dir: str) -> Replica:
    """The log in three batches out of order, with a suspension, two resumes, a compaction and a replay.

    Positions up to AS_OF_SEQ come with the first two batches, later ones with all three.
    """
    name = (spark.sparkContext.applicationId, sf_dir)
    if name in DISORDERED:
        return DISORDERED[name]
    replica = new_replica(spark, sf_dir, error_limit=1)
    early = F.when(F.col("seq") <= AS_OF_SEQ, 2).otherwise(3)
    log = pay.changes(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("seq"), early))
    for i in (0, 1):
        replica.apply_batch(log.where(F.col("part") == i), i)
    replica.resume()
    replica.resume()
    replica.compact(AS_OF_SEQ)
    for i in (1, 2):  # the second once more, as after a crash before its checkpoint
        replica.apply_batch(log.where(F.col("part") == i), i)
    DISORDERED[name] = replica
    return replica


@query
def replica_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disordered_replica(spark, sf_dir).state()


@query
def replica_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts of the disordered log, as log order decides them."""
    return disordered_replica(spark, sf_dir).errors()


@query
def replica_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches' lines add up to what one batch would have counted."""
    names = ("inserts", "updates", "deletes", "errors", "ignored", "stale")
    return disordered_replica(spark, sf_dir).stats().agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


@query
def replica_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second full load in the middle of the log; the changes behind its position stay on top."""
    replica = new_replica(spark, sf_dir)
    replica.apply_batch(pay.changes(spark, sf_dir), 0)
    replica.load(apply.as_of(pay.accounts(spark, sf_dir), pay.changes(spark, sf_dir), ["k"], ["amount"], AS_OF_SEQ), AS_OF_SEQ)
    return replica.state().select("k", "amount")  # loaded rows carry the position of the load


@query
def change_history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots closed by the watermark, appended by the stream."""
    path = scratch(spark, "history")
    (
        history.change_history(change_stream(spark, sf_dir))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/slots")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{path}/slots")
