"""Rename rules: schema renames and lower-casing of table and column names; selection of tables."""

from __future__ import annotations

import fnmatch
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from proofline.contract import ContractError


@dataclass(frozen=True)
class RenameRule:
    """``target`` is schema, table or column; ``action`` is rename or convert-lowercase.

    ``pattern`` selects names with ``%`` wildcards; ``value`` is the new name of a rename.
    """

    target: str
    action: str
    pattern: str = "%"
    value: str | None = None

    def apply(self, target: str, name: str) -> str:
        if target != self.target or not fnmatch.fnmatchcase(name, self.pattern.replace("%", "*")):
            return name
        if self.action == "rename":
            if self.value is None:
                raise ValueError("a rename rule needs a value")
            return self.value
        if self.action == "convert-lowercase":
            return name.lower()
        raise ValueError(f"unknown rename action {self.action!r}")


def parse_rules(mapping: dict) -> tuple[list[RenameRule], list[str]]:
    """Rename rules and included table patterns of a mapping document, in rule order."""
    renames, included = [], []
    for rule in sorted(mapping.get("rules", []), key=lambda r: int(r["rule-id"])):
        where = rule.get("object-locator", {})
        if rule["rule-type"] == "selection":
            if rule["rule-action"] == "include":
                included.append(where.get("table-name", "%"))
        elif rule["rule-type"] == "transformation":
            target = rule["rule-target"]
            renames.append(
                RenameRule(target, rule["rule-action"], where.get(f"{target}-name", "%"), rule.get("value"))
            )
        else:
            raise ValueError(f"unknown rule type {rule['rule-type']!r}")
    return renames, included


def rename(target: str, name: str, rules: list[RenameRule]) -> str:
    for rule in rules:
        name = rule.apply(target, name)
    return name


def rename_columns(df: DataFrame, rules: list[RenameRule]) -> DataFrame:
    return df.toDF(*[rename("column", c, rules) for c in df.columns])


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


@dataclass(frozen=True)
class Locator:
    """Patterns with ``%`` wildcards for a schema, a table of it and a column of that."""

    schema: str = "%"
    table: str = "%"
    column: str = "%"

    def matches(self, *path: str) -> bool:
        """Whether the path (schema, table, column, or its beginning) fits; case counts."""
        patterns = (self.schema, self.table, self.column)
        return all(re.fullmatch(".*".join(map(re.escape, p.split("%"))), n, re.DOTALL) for p, n in zip(patterns, path, strict=False))

    def specificity(self, depth: int) -> tuple[int, int]:
        """Parts without a wildcard first, then characters that are not wildcards."""
        parts = (self.schema, self.table, self.column)[:depth]
        return sum("%" not in p for p in parts), sum(len(p.replace("%", "")) for p in parts)


DEPTH = {"schema": 1, "table": 2, "column": 3}


@dataclass(frozen=True)
class Mapping:
    """Which tables of a source are taken, and what their schema, tables and columns are called.

    A table is taken if an inclusion fits and no exclusion does. Of the rules for one name the most
    specific locator wins; equally specific ones must agree, otherwise the mapping is refused.
    """

    included: tuple[Locator, ...] = ()
    excluded: tuple[Locator, ...] = ()
    renames: tuple[tuple[Locator, RenameRule], ...] = ()

    @classmethod
    def from_dict(cls, mapping: dict) -> Mapping:
        included, excluded, renames = [], [], []
        ids = [r["rule-id"] for r in mapping.get("rules", [])]
        if len(set(ids)) != len(ids):
            raise ContractError("a rule id is used twice")
        for rule in mapping.get("rules", []):
            where = rule.get("object-locator", {})
            locator = Locator(*(where.get(f"{part}-name", "%") for part in DEPTH))
            kind, action = rule["rule-type"], rule["rule-action"]
            if rule.get("filters"):
                raise ContractError(f"rule {rule['rule-id']}: row filters of a mapping are not supported")
            if kind == "selection" and action in ("include", "exclude"):
                (included if action == "include" else excluded).append(locator)
            elif kind == "transformation" and rule["rule-target"] in DEPTH and action in ("rename", "convert-lowercase"):
                renames.append((locator, RenameRule(rule["rule-target"], action, "%", rule.get("value"))))
            else:
                raise ContractError(f"rule {rule['rule-id']}: unknown {kind} {action!r}")
        return cls(tuple(included), tuple(excluded), tuple(renames))

    def selects(self, schema: str, table: str) -> bool:
        fits = [any(w.matches(schema, table) for w in some) for some in (self.included, self.excluded)]
        return fits[0] and not fits[1]

    def name(self, target: str, *path: str) -> str:
        """The new name of the last part of a path of source names."""
        depth = DEPTH[target]
        found = [(w.specificity(depth), r) for w, r in self.renames if r.target == target and w.matches(*path)]
        top = max((s for s, _ in found), default=None)
        names = {r.apply(target, path[-1]) for s, r in found if s == top}
        if len(names) > 1:
            raise ContractError(f"rules of one specificity call {'.'.join(path)} {sorted(names)}")
        return names.pop() if names else path[-1]

    def apply(self, schema: str, frames: dict[str, DataFrame]) -> dict[tuple[str, str], DataFrame]:
        """The selected frames with their columns renamed, under their new (schema, table) names."""
        out: dict[tuple[str, str], DataFrame] = {}
        for table, df in frames.items():
            if not self.selects(schema, table):
                continue
            columns = [self.name("column", schema, table, c) for c in df.columns]
            if len({c.lower() for c in columns}) != len(columns):
                raise ContractError(f"{schema}.{table}: two columns get one name: {columns}")
            key = self.name("schema", schema), self.name("table", schema, table)
            if key in out:
                raise ContractError(f"two tables get the name {'.'.join(key)}")
            out[key] = df.toDF(*columns)
        return out
