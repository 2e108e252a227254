"""Typed values out of text or near-typed columns, and the rows that do not conform.

Nothing here raises on bad data and nothing rounds: every column yields a value
and, beside it, the reason why that value may not be used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.contract import MONEY, Column as Declared, ContractError, Table

ERRORS = "_errors"
ERROR_LIST = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in ("column", "reason", "value")]))
CORRUPT = "_corrupt_line"

# Text forms accepted by the typed readers (fixed values).
INTEGER_TEXT = r"^[+-]?\d+$"
NUMBER_TEXT = r"^[+-]?\d+(\.\d+)?$"
MONEY_TEXT = r"^[+-]?\d+(\.\d{1,4})?$"
UUID_TEXT = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?$"
ZONED_TEXT = r"(Z|[+-]\d{2}:?\d{2})$"
REPLACEMENT = "�"


def money(c: Column, value: Column) -> Column:
    return F.when(
        value.isNull() | ~c.rlike(MONEY_TEXT),
        F.when(~c.rlike(NUMBER_TEXT), "not a number").when(~c.rlike(MONEY_TEXT), "more than 4 decimals").otherwise("out of range"),
    )


def boolean(c: Column) -> Column:
    return F.when(c == "1", True).when(c == "0", False)


def integer(c: Column, value: Column) -> Column:
    return F.when(~c.rlike(INTEGER_TEXT), "not a whole number").when(value.isNull(), "out of range")


def attach_zone(naive: Column, zone: str) -> Column:
    """Read a zone-less timestamp as local time of ``zone``; needs a UTC session."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), naive.cast("timestamp_ntz")).cast("timestamp")


def timestamp_text(c: Column, zone: str) -> Column:
    """Attach ``zone`` to naive text, convert text that states its own offset."""
    return F.when(c.rlike(ZONED_TEXT), c.try_cast("timestamp")).otherwise(attach_zone(c.try_cast("timestamp_ntz"), zone))


def trimmed(c: Column) -> Column:
    """A fixed-width value without its padding, for comparison and export."""
    return F.rtrim(c)


def text_value(col: Declared, c: Column, zone: str) -> Column:
    """The typed value of a text, NULL where there is none."""
    if col.type == "bool":
        return boolean(c)
    if col.type == "uuid":
        return F.lower(c)
    if col.type == "timestamp":
        return timestamp_text(c, zone)
    return c.try_cast(col.spark_type)


def text_problem(col: Declared, c: Column, value: Column) -> Column:
    """Why a text may not be used as ``value``, NULL where it may."""
    if col.type == "money":
        return money(c, value)
    if col.type in ("int", "bigint"):
        return integer(c, value)
    if col.type == "bool":
        return F.when(value.isNull(), "neither 0 nor 1")
    if col.type == "uuid":
        return F.when(~value.rlike(UUID_TEXT), "not a uuid")
    if col.type == "date":
        return F.when(value.isNull() | ~c.rlike(DATE_TEXT), "not a date")
    if col.type == "timestamp":
        return F.when(value.isNull() | ~c.rlike(TIMESTAMP_TEXT), "not a timestamp")
    return F.when(c.contains(REPLACEMENT), "undecodable characters")


def typed_value(col: Declared, c: Column, have: T.DataType, zone: str, where: str) -> Column:
    """The value of a column that is already typed; a type that cannot be exact fails here."""
    if col.type == "money" and isinstance(have, (T.DecimalType, T.IntegralType)):
        return c.try_cast(MONEY)
    if col.type == "money":
        raise ContractError(f"{where}: money arrives as {have.simpleString()}, which is not exact")
    if col.type == "timestamp" and isinstance(have, T.TimestampNTZType):
        return attach_zone(c, zone)
    if col.type in ("int", "bigint") and isinstance(have, T.IntegralType):
        return c.try_cast(col.spark_type)
    if col.type == "bool" and isinstance(have, T.IntegralType):
        return F.when(c == 1, True).when(c == 0, False)
    if have == col.spark_type:
        return c
    raise ContractError(f"{where}: {have.simpleString()} cannot be read as {col.type}")


def typed_problem(col: Declared, c: Column, value: Column, have: T.DataType) -> Column:
    if col.type == "bool" and isinstance(have, T.IntegralType):
        return F.when(value.isNull(), "neither 0 nor 1")
    lost = F.when(value.isNull(), "out of range")
    if col.type == "money" and isinstance(have, T.DecimalType) and have.scale > MONEY.scale:
        # the comparison happens in the wider type, so a lost digit shows
        return lost.when(c != value, "more than 4 decimals")
    return lost


def conform(df: DataFrame, table: Table, zone: str = "UTC") -> DataFrame:
    """Typed columns of ``table`` plus ``_errors``, one entry per offending value.

    Projections only: no shuffle, no Python. Values, then reasons, then the error list
    are separate steps, so each is computed once, and the list only for rows that need
    one. Generated columns are computed here from their expression, never read.
    """
    raw = {c.name: F.col(f"_raw_{c.name}") for c in table.stored}
    have = {c.name: df.schema[c.name].dataType for c in table.stored}
    renamed = df.select(
        *[F.col(c.name).alias(f"_raw_{c.name}") for c in table.stored], *([CORRUPT] if CORRUPT in df.columns else [])
    )

    def value(col: Declared) -> Column:
        if isinstance(have[col.name], T.StringType):
            return text_value(col, raw[col.name], zone)
        return typed_value(col, raw[col.name], have[col.name], zone, f"{table.name}.{col.name}")

    def reason(col: Declared) -> Column:
        c, v = raw[col.name], F.col(col.name)
        if isinstance(have[col.name], T.StringType):
            why = text_problem(col, c, v)
        else:
            why = typed_problem(col, c, v, have[col.name])
        return F.when(c.isNull(), F.lit(None if col.nullable else "missing")).otherwise(why)

    valued = renamed.select("*", *[value(c).cast(c.spark_type).alias(c.name) for c in table.stored])
    reasoned = valued.select("*", *[reason(c).alias(f"_why_{c.name}") for c in table.stored])

    def entry(column: str, why: Column, text: Column) -> Column:
        found = F.struct(F.lit(column).alias("column"), why.alias("reason"), text.cast("string").alias("value"))
        return F.when(why.isNotNull(), found)

    whys = {c.name: F.col(f"_why_{c.name}") for c in table.stored}
    entries = [entry(n, why, raw[n]) for n, why in whys.items()]
    suspicious = F.coalesce(*whys.values()).isNotNull()
    if CORRUPT in df.columns:
        line = F.col(CORRUPT)
        entries.append(entry("*", F.when(line.isNotNull(), "wrong number of fields"), line))
        suspicious = suspicious | line.isNotNull()
    found = F.array_compact(F.array(*entries))
    errors = F.when(suspicious, found).otherwise(F.array().cast(ERROR_LIST))
    return add_generated(reasoned.select(*[c.name for c in table.stored], errors.alias(ERRORS)), table)


def add_generated(df: DataFrame, table: Table) -> DataFrame:
    """Compute the generated columns, in declared order, rounded to money."""
    made = {c.name: F.expr(c.expr).try_cast(MONEY) for c in table.columns if c.generated and c.expr}
    rest = [F.col(n) for n in df.columns if n not in table.names()]
    have = set(df.columns) | set(made)
    ordered = [made[n].alias(n) if n in made else F.col(n) for n in table.names() if n in have]
    return df.select(*ordered, *rest)


def accepted(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.size(ERRORS) == 0).drop(ERRORS)


def rejects(conformed: DataFrame, table: Table) -> DataFrame:
    """One row per offending value: table, key, column, reason and the text as read."""
    return (
        conformed.where(F.size(ERRORS) > 0)
        .select(F.lit(table.name).alias("table_name"), F.col(table.key).cast("string").alias("row_key"), F.explode(ERRORS).alias("e"))
        .select("table_name", "row_key", "e.column", "e.reason", "e.value")
    )
