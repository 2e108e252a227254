"""The declared schema: which tables exist, what their columns mean, how they link.

A contract is parsed once on the driver. Its semantic types decide how a column
is read, converted and checked, so a mistyped one must fail here: later it would
only remove the column from every check without a word.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field
from pathlib import Path
from zoneinfo import ZoneInfo

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 4)

# Semantic type -> Spark type. Fixed values of the contract format.
SPARK_TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "text": T.StringType(),
    "char": T.StringType(),
    "money": MONEY,
    "bool": T.BooleanType(),
    "uuid": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "generated": MONEY,
}

SUMMED = ("money", "generated")
RANGED = ("timestamp", "date")


class ContractError(ValueError):
    """The contract, or a frame measured against it, is not usable."""


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool = False
    expr: str | None = None  # SQL of a generated column

    @property
    def generated(self) -> bool:
        return self.type == "generated"

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.type]


@dataclass(frozen=True)
class ParentLink:
    column: str
    table: str


@dataclass(frozen=True)
class Table:
    name: str
    key: str
    columns: tuple[Column, ...]
    parents: tuple[ParentLink, ...] = ()

    def names(self, *types: str) -> list[str]:
        """Column names, all of them or those of the given semantic types."""
        return [c.name for c in self.columns if not types or c.type in types]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")

    @property
    def stored(self) -> list[Column]:
        """Columns that are read and written; generated ones are computed instead."""
        return [c for c in self.columns if not c.generated]

    @property
    def money(self) -> list[str]:
        return self.names(*SUMMED)

    @property
    def dated(self) -> list[str]:
        return self.names(*RANGED)

    @property
    def nullable(self) -> list[str]:
        return [c.name for c in self.columns if c.nullable]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, True) for c in self.columns])

    def text_struct(self) -> T.StructType:
        """All-string schema of a delimited file: nothing is parsed by the reader."""
        return T.StructType([T.StructField(c.name, T.StringType(), True) for c in self.stored])


@dataclass(frozen=True)
class CaseCheck:
    """A column whose values differ only by case, and the value queries filter on."""

    table: str
    column: str
    value: str
    variants: tuple[str, ...] = ()


@dataclass(frozen=True)
class UnicodeCheck:
    table: str
    column: str
    patterns: tuple[str, ...]


@dataclass(frozen=True)
class Projection:
    """A named column list of one table: a service boundary."""

    name: str
    table: str
    columns: tuple[str, ...]
    where: str | None = None


@dataclass(frozen=True)
class Contract:
    tables: tuple[Table, ...]  # parents first
    source_timezone: str = "UTC"
    source_schema: str = "dbo"
    target_schema: str = "public"
    case_check: CaseCheck | None = None
    unicode_check: UnicodeCheck | None = None
    projections: tuple[Projection, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        _validate(self)

    @property
    def names(self) -> list[str]:
        return [t.name for t in self.tables]

    def table(self, name: str) -> Table:
        for t in self.tables:
            if t.name == name:
                return t
        raise KeyError(name)

    def edges(self) -> list[tuple[Table, ParentLink, Table]]:
        """(child, link, parent) for every declared parent link."""
        return [(t, p, self.table(p.table)) for t in self.tables for p in t.parents]

    def select_tables(self, pattern: str) -> list[str]:
        """Tables whose name matches an inclusion pattern with ``%`` wildcards."""
        rx = re.compile(".*".join(re.escape(p) for p in pattern.split("%")), re.IGNORECASE)
        return [n for n in self.names if rx.fullmatch(n)]


def _validate(contract: Contract) -> None:
    seen: set[str] = set()
    for t in contract.tables:
        if not t.name or not t.key:
            raise ContractError("every table needs a name and a primary key")
        if t.name in seen:
            raise ContractError(f"table {t.name} is declared twice")
        names = t.names()
        if len(set(names)) != len(names):
            raise ContractError(f"{t.name}: a column is declared twice")
        for c in t.columns:
            if c.type not in SPARK_TYPES:
                raise ContractError(
                    f"{t.name}.{c.name}: unknown type {c.type!r}; "
                    f"known types are {', '.join(sorted(SPARK_TYPES))}"
                )
        if t.key not in names:
            raise ContractError(f"{t.name}: primary key {t.key!r} is not one of its columns")
        for p in t.parents:
            if p.column not in names:
                raise ContractError(f"{t.name}: parent column {p.column!r} is not declared")
            if p.table not in seen:
                raise ContractError(f"{t.name}: parent {p.table!r} must be listed before it")
        seen.add(t.name)
    for check in (contract.case_check, contract.unicode_check):
        if check and (check.table not in seen or check.column not in contract.table(check.table).names()):
            raise ContractError(f"check names {check.table}.{check.column}, which is not declared")
    for p in contract.projections:
        missing = set(p.columns) - set(contract.table(p.table).names() if p.table in seen else ())
        if missing:
            raise ContractError(f"projection {p.name}: {sorted(missing)} not in {p.table}")
    try:
        ZoneInfo(contract.source_timezone)
    except Exception as exc:
        raise ContractError(f"unknown source time zone {contract.source_timezone!r}") from exc


def from_dict(raw: dict) -> Contract:
    """Build a contract from its JSON form. Keys starting with ``_`` are comments."""
    tables = []
    for t in raw.get("tables", []):
        if "name" not in t or "primary_key" not in t:
            raise ContractError(f"table needs name and primary_key: {t}")
        links = list(t.get("parents", [])) + ([t["parent"]] if "parent" in t else [])
        tables.append(
            Table(
                t["name"],
                t["primary_key"],
                tuple(
                    Column(c["name"], c["type"], bool(c.get("nullable", False)), c.get("expr"))
                    for c in t["columns"]
                ),
                tuple(ParentLink(p["column"], p["table"]) for p in links),
            )
        )
    case, uni = raw.get("collation_check"), raw.get("unicode_check")
    return Contract(
        tables=tuple(tables),
        source_timezone=raw.get("source_timezone", "UTC"),
        source_schema=raw.get("source_schema", "dbo"),
        target_schema=raw.get("target_schema", "public"),
        case_check=CaseCheck(case["table"], case["column"], case["value"], tuple(case.get("variants", ())))
        if case
        else None,
        unicode_check=UnicodeCheck(uni["table"], uni["column"], tuple(uni["patterns"])) if uni else None,
        projections=tuple(
            Projection(p["name"], p["table"], tuple(p["columns"]), p.get("where"))
            for p in raw.get("projections", [])
        ),
    )


def load(path: str | None = None) -> Contract:
    """Read a contract file; the path may come from ``SCHEMA_CONFIG``."""
    chosen = path or os.environ.get("SCHEMA_CONFIG")
    if not chosen:
        raise ContractError("no contract file given")
    file = Path(chosen)
    if not file.exists():
        raise FileNotFoundError(f"contract file not found: {file}")
    return from_dict(json.loads(file.read_text(encoding="utf-8")))
