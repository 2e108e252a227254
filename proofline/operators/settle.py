"""Settlement reports and what is derived from captured transactions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.contract import MONEY
from proofline.functions.predicates import half_open, matches, rolling_window

CAPTURED = "Captured"
TOTAL = "decimal(38,4)"

# Split of a batch's gross into what is paid out and what is kept (fixed values).
NET_SHARE = "0.9705"
FEE_SHARE = "0.0295"


def fee_or_zero() -> Column:
    return F.coalesce(F.col("fee_amount"), F.lit(0).cast(MONEY))


def net_of_fee() -> Column:
    return F.col("amount") - fee_or_zero()


def totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").cast(TOTAL).alias("gross_amount"),
        F.sum(fee_or_zero()).cast(TOTAL).alias("total_fees"),
        F.sum(net_of_fee()).cast(TOTAL).alias("net_amount"),
    ]


def settlement_range(transactions: DataFrame, lo: datetime, hi: datetime, match: str = "folded") -> DataFrame:
    """Count and gross per merchant of the captured rows in ``[lo, hi)``."""
    rows = transactions.where(half_open(F.col("captured_at"), lo, hi) & matches(F.col("txn_status"), CAPTURED, match))
    return rows.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").cast(TOTAL).alias("gross")
    )


def daily_settlement(
    transactions: DataFrame, merchants: DataFrame, as_of: datetime | None, days_back: int | None = 7, match: str = "exact"
) -> DataFrame:
    """Per merchant and capture day: count, gross, fees and net of the rolling window, or of all days without one.

    Transactions shrink to one row per merchant and day before they meet the
    merchants, so a merchant with most of the transactions joins as a few rows.
    Names are attached after that and grouped again, in case an id has several.
    """
    rows = transactions.where(matches(F.col("txn_status"), CAPTURED, match) & F.col("captured_at").isNotNull())
    if days_back is not None:
        rows = rows.where(rolling_window(F.col("captured_at"), as_of, days_back))
    daily = rows.groupBy("merchant_id", F.to_date("captured_at").alias("capture_date")).agg(*totals())
    named = daily.join(merchants.select("merchant_id", "legal_name"), "merchant_id")
    return named.groupBy("merchant_id", "legal_name", "capture_date").agg(
        F.sum("txn_count").alias("txn_count"),
        *[F.sum(c).cast(TOTAL).alias(c) for c in ("gross_amount", "total_fees", "net_amount")],
    )


def report_order(report: DataFrame) -> DataFrame:
    """Latest day first, largest gross first; the merchant id makes the order total."""
    return report.orderBy(F.col("capture_date").desc(), F.col("gross_amount").desc(), "merchant_id", "legal_name")


def derive_batches(transactions: DataFrame, match: str = "folded") -> DataFrame:
    """One batch per merchant and day; settled once all of its rows are."""
    rows = transactions.where(matches(F.col("txn_status"), CAPTURED, match))
    every = F.count(F.lit(1))
    return rows.groupBy("merchant_id", F.to_date("captured_at").alias("batch_date")).agg(
        every.alias("txn_count"),
        F.sum("amount").cast(TOTAL).alias("gross_amount"),
        F.when(F.count("settled_at") == every, "Settled").otherwise("Pending").alias("batch_status"),
    )


def derive_settlements(batches: DataFrame, link: list[str] | None = None) -> DataFrame:
    """Net, fee and payout time of every settled batch.

    Net and fee are rounded half away from zero to 4 decimals each, so their sum may
    miss the gross by 0.0001.
    """
    keys = link or [c for c in ("batch_id", "merchant_id", "batch_date") if c in batches.columns]
    gross = F.col("gross_amount").cast(MONEY)
    share = lambda s: (gross * F.lit(s).cast("decimal(4,4)")).cast(MONEY)
    return batches.where(F.col("batch_status") == "Settled").select(
        *keys,
        share(NET_SHARE).alias("net_amount"),
        share(FEE_SHARE).alias("fee_amount"),
        F.date_add("batch_date", 2).cast("timestamp").alias("settled_at"),
    )
