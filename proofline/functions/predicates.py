"""Filters. Each takes and returns columns, so Catalyst can push what is pushable."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

FOLDED = "UTF8_LCASE"
FOLDED_TRIMMED = "UTF8_LCASE_RTRIM"
BINARY = "UTF8_BINARY"


def instant(moment: datetime) -> Column:
    """A timestamp literal that does not depend on any machine's local zone."""
    utc = moment.astimezone(timezone.utc) if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return F.lit(utc.isoformat()).cast("timestamp")


def half_open(c: Column, lo: datetime, hi: datetime) -> Column:
    """``lo <= c < hi``"""
    return (c >= instant(lo)) & (c < instant(hi))


def rolling_window(c: Column, as_of: datetime, days: int) -> Column:
    """The last ``days`` times 24 hours before ``as_of``, no upper bound."""
    return c >= instant(as_of - timedelta(days=days))


def calendar_start(as_of: datetime, days: int) -> datetime:
    """Midnight of the day ``days`` before ``as_of``."""
    return (as_of - timedelta(days=days)).replace(hour=0, minute=0, second=0, microsecond=0)


def calendar_window(c: Column, as_of: datetime, days: int) -> Column:
    """Whole days: from midnight of the day ``days`` before ``as_of``."""
    return c >= instant(calendar_start(as_of, days))


def exact(c: Column, value: str) -> Column:
    return c == F.lit(value)


def folded(c: Column, value: str) -> Column:
    return F.lower(c) == F.lower(F.lit(value))


def matches(c: Column, value: str, mode: str) -> Column:
    """``exact`` is byte equality, ``folded`` ignores case; callers say which they mean."""
    if mode == "exact":
        return exact(c, value)
    if mode == "folded":
        return folded(c, value)
    raise ValueError(f"match mode {mode!r} is neither 'exact' nor 'folded'")


def collation_equal(c: Column, value: str, collation: str = FOLDED_TRIMMED) -> Column:
    """Equality the way a case- and trailing-blank-insensitive database sees it."""
    return F.collate(c, collation) == F.lit(value)


def case_sensitive_equal(c: Column, value: str) -> Column:
    """Byte equality even where the column carries a folding collation."""
    return F.collate(c, BINARY) == F.lit(value)


def any_like(c: Column, patterns: tuple[str, ...] | list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.like(p) for p in patterns])


def whole_blocks(c: Column, width: int) -> Column:
    """Block number of a whole number, in whole-number arithmetic: no key is too large for it."""
    return F.call_function("div", c.cast("bigint"), F.lit(width).cast("bigint"))
