"""The payments contract, and the same tables derived from the driver's data.

Each derived table is a list of SQL expressions valid in Spark and in DuckDB, so the
queries and their oracles start from one text.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from proofline.contract import Column, Contract, CaseCheck, ParentLink, Projection, Table, UnicodeCheck


def _columns(*declared: str) -> tuple[Column, ...]:
    """``name type`` or ``name type null`` or ``name generated = expression``."""
    out = []
    for text in declared:
        head, _, expr = text.partition("=")
        name, kind, *rest = head.split()
        out.append(Column(name, kind, "null" in rest, expr.strip() or None))
    return tuple(out)


# The contract's tables, in loading order (fixed values).
MERCHANTS = Table(
    "merchants",
    "merchant_id",
    _columns(
        "merchant_id int", "merchant_guid uuid", "legal_name text", "dba_name text null", "mcc char",
        "is_active bool", "onboarding_status text", "created_at timestamp", "updated_at timestamp null",
    ),
)
TRANSACTIONS = Table(
    "transactions",
    "txn_id",
    _columns(
        "txn_id bigint", "merchant_id int", "amount money", "fee_amount money", "currency char",
        "card_last4 char null", "auth_code text null", "txn_status text", "captured_at timestamp",
        "settled_at timestamp null",
    ),
    (ParentLink("merchant_id", "merchants"),),
)
BATCHES = Table(
    "batches",
    "batch_id",
    _columns(
        "batch_id int", "merchant_id int", "batch_date date", "txn_count int", "gross_amount money", "batch_status text"
    ),
    (ParentLink("merchant_id", "merchants"),),
)
SETTLEMENTS = Table(
    "settlements",
    "settlement_id",
    _columns(
        "settlement_id int", "batch_id int", "net_amount money", "fee_amount money",
        "gross_amount generated = net_amount + fee_amount", "settled_at timestamp",
    ),
    (ParentLink("batch_id", "batches"),),
)

PUBLIC_MERCHANT = Projection("merchant_public", "merchants", ("merchant_id", "merchant_guid", "is_active"))

PAYMENTS = Contract(
    tables=(MERCHANTS, TRANSACTIONS, BATCHES, SETTLEMENTS),
    case_check=CaseCheck("transactions", "txn_status", "Captured", ("Captured", "captured", "CAPTURED")),
    unicode_check=UnicodeCheck("merchants", "legal_name", ("%北方%", "%Трейд%", "%Móvil%")),
    projections=(
        Projection("merchant_svc_merchants", "merchants", tuple(MERCHANTS.names())),
        Projection("txn_svc_transactions", "transactions", tuple(TRANSACTIONS.names())),
        Projection("settlement_svc_batches", "batches", tuple(BATCHES.names())),
        Projection("settlement_svc_settlements", "settlements", tuple(SETTLEMENTS.names())),
        PUBLIC_MERCHANT,
    ),
)

# -- derived tables: name -> (driver table, {column: expression}) ------------

_CAPTURED_AT = "o_orderdate + (o_orderkey * 7919 % 86400) * INTERVAL '1' SECOND"
_AMOUNT = "CAST(o_totalprice AS DECIMAL(19,4))"
_HASH = "md5(CAST(c_custkey AS STRING))"

MERCHANT_COLUMNS = {
    "merchant_id": "CAST(c_custkey AS INT)",
    "merchant_guid": (
        f"substr({_HASH}, 1, 8) || '-' || substr({_HASH}, 9, 4) || '-' || substr({_HASH}, 13, 4) || '-' || "
        f"substr({_HASH}, 17, 4) || '-' || substr({_HASH}, 21, 12)"
    ),
    "legal_name": (
        "CASE c_custkey % 20 WHEN 0 THEN '北方物流 ' || c_name WHEN 7 THEN 'Balkan Трейд ' || c_name "
        "WHEN 13 THEN 'Café Móvil ' || c_name ELSE c_name END"
    ),
    "dba_name": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name || ' Direct' END",
    "mcc": "lpad(CAST(5000 + c_nationkey * 11 AS STRING), 4, '0')",
    "is_active": "c_custkey % 7 <> 0",
    "onboarding_status": "c_mktsegment",
    "created_at": "CAST(TIMESTAMP '2024-01-01 00:00:00' + (c_custkey * 7919 % 8640000) * INTERVAL '1' SECOND AS TIMESTAMP)",
    "updated_at": (
        "CASE WHEN c_custkey % 5 < 2 THEN NULL ELSE CAST(TIMESTAMP '2024-06-01 00:00:00' + "
        "(c_custkey * 104729 % 8640000) * INTERVAL '1' SECOND AS TIMESTAMP) END"
    ),
}

TRANSACTION_COLUMNS = {
    "txn_id": "o_orderkey",
    "merchant_id": "CAST(o_custkey AS INT)",
    "amount": _AMOUNT,
    "fee_amount": f"CAST({_AMOUNT} * CAST(0.0295 AS DECIMAL(4,4)) AS DECIMAL(19,4))",
    "currency": "CASE o_orderkey % 5 WHEN 3 THEN 'CAD' WHEN 4 THEN 'EUR' ELSE 'USD' END",
    "card_last4": "CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0') END",
    "auth_code": "CASE WHEN o_orderkey % 20 = 1 THEN NULL ELSE CAST(100000 + o_orderkey * 31 % 900000 AS STRING) END",
    "txn_status": (
        "CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'Captured' "
        "WHEN o_orderkey % 3 = 1 THEN 'captured' ELSE 'CAPTURED' END "
        "WHEN o_orderstatus = 'O' THEN 'Authorized' ELSE 'Voided' END"
    ),
    "captured_at": f"CAST({_CAPTURED_AT} AS TIMESTAMP)",
    "settled_at": (
        "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 <> 0 "
        f"THEN CAST({_CAPTURED_AT} + INTERVAL '2' DAY AS TIMESTAMP) END"
    ),
}

NEW_KEYS = 1_000_000_000_000
CHANGE_COLUMNS = {
    # every second key of the log has no account, so inserts and updates of both kinds meet their conflicts
    "k": f"CASE WHEN user_id % 2 = 0 THEN user_id ELSE user_id + {NEW_KEYS} END",
    "seq": "event_id",
    "commit_ts": "CAST(ts AS TIMESTAMP)",
    "op": "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END",
    "amount": "CAST(value AS DECIMAL(19,4))",
}

# The rows the change log starts from.
ACCOUNT_COLUMNS = {
    "k": "c_custkey",
    "amount": "CAST(c_acctbal AS DECIMAL(19,4))",
    "seq": "CAST(-1 AS BIGINT)",
}

# Planted differences between the original transactions and a migrated copy.
PLANTED_COLUMNS = {
    "amount": f"{_AMOUNT} + CASE WHEN o_orderkey % 997 = 5 THEN CAST(0.0001 AS DECIMAL(19,4)) ELSE CAST(0 AS DECIMAL(19,4)) END",
    "merchant_id": "CAST(CASE WHEN o_orderkey % 991 = 7 THEN 1000000 + o_custkey ELSE o_custkey END AS INT)",
    "captured_at": f"CAST({_CAPTURED_AT} + CASE WHEN o_orderkey % 983 = 3 THEN 1 ELSE 0 END * INTERVAL '1' HOUR AS TIMESTAMP)",
    "auth_code": "CASE WHEN o_orderkey % 20 = 1 AND o_orderkey % 977 <> 1 THEN NULL ELSE CAST(100000 + o_orderkey * 31 % 900000 AS STRING) END",
}
PLANTED_FILTER = "o_orderkey % 1009 <> 11"  # the rows a copy lost
MIGRATED_COLUMNS = {
    n: f"CAST({PLANTED_COLUMNS[n]} AS DECIMAL(19,4))" if n == "amount" else PLANTED_COLUMNS.get(n, e)
    for n, e in TRANSACTION_COLUMNS.items()
}

# Names as a wrong encoding reads them, and the batches a copy has.
MISREAD_NAME = "CASE WHEN merchant_id % 40 = 0 THEN replace(legal_name, '北方物流', 'σîùµû╣τë⌐µ╡ü') ELSE legal_name END"
BATCH_FILTER = "merchant_id % 101 <> 3"

# A copy of the merchants: identifiers in capitals, some names changed, some rows missing.
COPIED_MERCHANT_COLUMNS = {
    **{n: n for n in MERCHANT_COLUMNS},
    "merchant_guid": "upper(merchant_guid)",
    "legal_name": "CASE WHEN merchant_id % 89 = 5 THEN legal_name || ' ' WHEN merchant_id % 89 = 6 THEN substr(legal_name, 1, 9) ELSE legal_name END",
    "dba_name": "CASE WHEN merchant_id % 97 = 8 THEN NULL ELSE dba_name END",
}
COPIED_MERCHANT_FILTER = "merchant_id % 83 <> 7"

# The derived tables as text, the way a file brings them, with values that do not conform.
RAW_MERCHANT_COLUMNS = {
    "merchant_id": "CAST(merchant_id AS STRING)",
    "merchant_guid": (
        "CASE WHEN merchant_id % 61 = 5 THEN 'not-a-guid' WHEN merchant_id % 3 = 0 THEN upper(merchant_guid) ELSE merchant_guid END"
    ),
    "legal_name": "CASE WHEN merchant_id % 67 = 9 THEN NULL ELSE legal_name END",
    "dba_name": "dba_name",
    "mcc": "mcc",
    "is_active": "CASE WHEN merchant_id % 59 = 4 THEN '2' WHEN is_active THEN '1' ELSE '0' END",
    "onboarding_status": "onboarding_status",
    "created_at": "CASE WHEN merchant_id % 71 = 8 THEN '2024-13-01 00:00:00' ELSE CAST(created_at AS STRING) END",
    "updated_at": "CAST(updated_at AS STRING)",
}
RAW_TRANSACTION_COLUMNS = {
    "txn_id": "CAST(txn_id AS STRING)",
    "merchant_id": "CASE WHEN txn_id % 103 = 6 THEN '12x' ELSE CAST(merchant_id AS STRING) END",
    "amount": (
        "CASE WHEN txn_id % 97 = 1 THEN '1.00001' WHEN txn_id % 97 = 2 THEN 'abc' "
        "WHEN txn_id % 97 = 3 THEN '12345678901234567.0' ELSE CAST(amount AS STRING) END"
    ),
    "fee_amount": "CAST(fee_amount AS STRING)",
    "currency": "currency",
    "card_last4": "card_last4",
    "auth_code": "auth_code",
    "txn_status": "txn_status",
    # every fourth text states its own offset
    "captured_at": "CAST(captured_at AS STRING) || CASE WHEN txn_id % 4 = 1 THEN '+02:00' ELSE '' END",
    "settled_at": "CAST(settled_at AS STRING)",
}


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in columns.items()]


def select_sql(columns: dict[str, str], table: str, where: str | None = None) -> str:
    """The oracle's text of a derived table."""
    return f"SELECT {', '.join(select_list(columns))} FROM {table}" + (f" WHERE {where}" if where else "")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(*select_list(MERCHANT_COLUMNS))


def transactions(spark: SparkSession, sf_dir: str, lo: datetime | None = None, hi: datetime | None = None) -> DataFrame:
    """Transactions, optionally of orders that can fall into ``[lo, hi)``.

    The capture time is computed from the order date and lies on that day, so the
    bounds reach the Parquet scan as filters on the order date.
    """
    orders = read(spark, sf_dir, "orders")
    if lo is not None:
        orders = orders.where(f"o_orderdate > TIMESTAMP_NTZ '{lo - timedelta(days=1):%Y-%m-%d %H:%M:%S}'")
    if hi is not None:
        orders = orders.where(f"o_orderdate < TIMESTAMP_NTZ '{hi:%Y-%m-%d %H:%M:%S}'")
    return orders.selectExpr(*select_list(TRANSACTION_COLUMNS))


def migrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of the transactions with the planted differences."""
    return read(spark, sf_dir, "orders").where(PLANTED_FILTER).selectExpr(*select_list(MIGRATED_COLUMNS))


def copied_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merchants(spark, sf_dir).where(COPIED_MERCHANT_FILTER).selectExpr(*select_list(COPIED_MERCHANT_COLUMNS))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(*select_list(CHANGE_COLUMNS))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(*select_list(ACCOUNT_COLUMNS))
