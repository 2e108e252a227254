from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from proofline.contract import Column, ContractError, Table
from proofline.functions import conform as C
from proofline.functions import predicates as P

ALL = Table(
    "all_types",
    "id",
    (
        Column("id", "bigint"), Column("n", "int", True), Column("m", "money", True), Column("b", "bool", True),
        Column("u", "uuid", True), Column("t", "timestamp", True), Column("d", "date", True), Column("s", "text", True),
        Column("twice", "generated", expr="m * 2"),
    ),
)


def conformed(spark, zone="UTC", **value):
    row = {c.name: None for c in ALL.stored} | {"id": "1"} | value
    schema = ", ".join(f"{c.name} string" for c in ALL.stored)
    return C.conform(spark.createDataFrame([tuple(row.values())], schema), ALL, zone)


def one(spark, column, text, zone="UTC"):
    df = conformed(spark, zone, **{column: text})
    if column == "t":
        df = df.withColumn("t", F.col("t").cast("string"))
    row = df.first()
    return row[column], [(e["column"], e["reason"]) for e in row[C.ERRORS]]


GOOD = [
    ("m", "0.01", Decimal("0.0100")),
    ("m", "-29.99", Decimal("-29.9900")),
    ("m", "199999.1234", Decimal("199999.1234")),
    ("m", "999999999999999.9999", Decimal("999999999999999.9999")),
    ("b", "1", True),
    ("b", "0", False),
    ("n", "-2147483648", -2147483648),
    ("u", "0F8FAD5B-D9CB-469F-A165-70867728950E", "0f8fad5b-d9cb-469f-a165-70867728950e"),
    ("d", "2026-02-28", datetime(2026, 2, 28).date()),
    ("s", "北方物流", "北方物流"),
    ("s", "  padded ", "  padded "),
]


@pytest.mark.parametrize("column,text,value", GOOD)
def test_conforming_values(spark, column, text, value):
    assert one(spark, column, text) == (value, [])


BAD = [
    ("m", "1.00001", "more than 4 decimals"),
    ("m", "1e3", "not a number"),
    ("m", "1,50", "not a number"),
    ("m", "NaN", "not a number"),
    ("m", "1000000000000000.0", "out of range"),
    ("b", "2", "neither 0 nor 1"),
    ("b", "true", "neither 0 nor 1"),
    ("n", "2147483648", "out of range"),
    ("n", "1.0", "not a whole number"),
    ("u", "0f8fad5b", "not a uuid"),
    ("d", "2026", "not a date"),
    ("d", "2026-02-30", "not a date"),
    ("t", "yesterday", "not a timestamp"),
    ("t", "2026-13-01 00:00:00", "not a timestamp"),
    ("s", "Z�rich", "undecodable characters"),
    ("id", None, "missing"),
]


@pytest.mark.parametrize("column,text,reason", BAD)
def test_values_that_do_not_conform(spark, column, text, reason):
    assert one(spark, column, text)[1] == [(column, reason)]


@pytest.mark.parametrize(
    "text,zone,utc",
    [
        ("2026-06-01 12:00:00.123", "UTC", "2026-06-01 12:00:00.123"),
        ("2026-06-01 12:00:00", "America/New_York", "2026-06-01 16:00:00"),
        ("2026-03-08 02:30:00", "America/New_York", "2026-03-08 07:30:00"),  # in the gap
        ("2026-11-01 01:30:00", "America/New_York", "2026-11-01 05:30:00"),  # in the overlap
        ("2026-06-01 12:00:00+02:00", "America/New_York", "2026-06-01 10:00:00"),  # states its own offset
        ("2026-06-01T12:00:00Z", "America/New_York", "2026-06-01 12:00:00"),
        ("2026-01-01 00:00:00", "Asia/Tokyo", "2025-12-31 15:00:00"),  # moves the day
    ],
)
def test_zones(spark, text, zone, utc):
    assert one(spark, "t", text, zone) == (utc, [])


def test_several_errors_of_one_row_are_all_kept(spark):
    df = conformed(spark, m="x", b="7")
    assert {(r["column"], r["value"]) for r in C.rejects(df, ALL).collect()} == {("m", "x"), ("b", "7")}
    assert C.accepted(df).count() == 0


def test_generated_column_is_computed(spark):
    row = conformed(spark, m="1.1111").first()
    assert row["twice"] == Decimal("2.2222")


def test_typed_input(spark):
    table = Table("t", "id", (Column("id", "int"), Column("m", "money"), Column("t", "timestamp"), Column("b", "bool")))
    df = spark.sql(
        "SELECT 5L AS id, CAST(1.23456 AS DECIMAL(20,5)) AS m, TIMESTAMP_NTZ '2026-06-01 12:00:00' AS t, 1 AS b "
        "UNION ALL SELECT 5000000000L, CAST(1.2 AS DECIMAL(20,5)), TIMESTAMP_NTZ '2026-06-01 12:00:00', 3"
    )
    out = C.conform(df, table, "America/New_York").withColumn("t", F.col("t").cast("string")).collect()
    assert [e["reason"] for e in out[0][C.ERRORS]] == ["more than 4 decimals"]
    assert out[0]["t"] == "2026-06-01 16:00:00" and out[0]["b"] is True
    assert {e["reason"] for e in out[1][C.ERRORS]} == {"out of range", "neither 0 nor 1"}


def test_money_never_comes_from_a_float(spark):
    table = Table("t", "id", (Column("id", "int"), Column("m", "money")))
    with pytest.raises(ContractError, match="not exact"):
        C.conform(spark.sql("SELECT 1 AS id, 1.5D AS m"), table)


def test_equality_modes(spark):
    words = spark.createDataFrame([("Captured",), ("captured",), ("CAPTURED ",), ("Cáptured",)], "s string")
    s = F.col("s")
    count = lambda cond: words.where(cond).count()
    assert count(P.exact(s, "Captured")) == 1
    assert count(P.folded(s, "Captured")) == 2
    assert count(P.collation_equal(s, "captured")) == 3
    assert count(P.case_sensitive_equal(F.collate(s, P.FOLDED), "Captured")) == 1
    assert count(P.any_like(s, ["Cap%", "%á%"])) == 2
    with pytest.raises(ValueError):
        P.matches(s, "x", "fuzzy")


def test_window_starts(spark):
    at = datetime(2026, 3, 10, 6, 15)
    rows = spark.sql("SELECT explode(array('2026-03-08 23:59:59', '2026-03-09 00:00:00', '2026-03-09 06:15:00', '2026-03-11 00:00:00')) AS x")
    c = F.col("x").cast("timestamp")
    assert rows.where(P.calendar_window(c, at, 1)).count() == 3
    assert rows.where(P.rolling_window(c, at, 1)).count() == 2
    assert rows.where(P.half_open(c, datetime(2026, 3, 9), datetime(2026, 3, 11))).count() == 2
