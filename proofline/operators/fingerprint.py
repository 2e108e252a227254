"""A table's fingerprint as rows: (table_name, check_name, subject, key, value).

Everything without a grouping comes from one aggregate over one scan. Values are
text, written by the engine itself from exact types: a measurement coarser than
the data would agree with damaged data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.contract import CaseCheck, Contract, Table, UnicodeCheck
from proofline.functions.predicates import any_like, exact, folded

FINGERPRINT = ["table_name", "check_name", "subject", "key", "value"]
TOTAL = "decimal(38,4)"
NO_KEY = ""


def exact_sum(column: str) -> Column:
    return F.sum(column).cast(TOTAL)


def moment_text(c: Column) -> Column:
    """ISO text of a date or an instant, to the microsecond."""
    return c.cast("string")


def scalar_measures(table: Table, case: CaseCheck | None, real: Column | None = None) -> list[tuple[str, str, str, Column]]:
    """(check, subject, key, aggregate) of everything one ungrouped scan answers; rows that are not ``real`` do not count."""
    real = F.lit(True) if real is None else real
    found = [("row_count", "*", NO_KEY, F.count_if(real).cast("string"))]
    found += [("money_sum", c, NO_KEY, exact_sum(c).cast("string")) for c in table.money]
    for c in table.dated:
        found.append(("date_range", c, "min", moment_text(F.min(c))))
        found.append(("date_range", c, "max", moment_text(F.max(c))))
    found += [("null_count", c, NO_KEY, F.count_if(real & F.col(c).isNull()).cast("string")) for c in table.nullable]
    found.append(("max_key", table.key, NO_KEY, F.max(table.key).cast("string")))
    if case:
        c = F.col(case.column)
        found.append(("match_count", case.column, "exact", F.count_if(exact(c, case.value)).cast("string")))
        found.append(("match_count", case.column, "folded", F.count_if(folded(c, case.value)).cast("string")))
    return found


def long_form(df: DataFrame, table: str, measures: list[tuple[str, str, str, Column]]) -> DataFrame:
    """One aggregate over one scan, then its single row turned into one row per measure."""
    row = df.agg(*[m.alias(f"m{i}") for i, (_, _, _, m) in enumerate(measures)])
    cells = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.lit(subject).alias("subject"),
            F.lit(key).alias("key"),
            F.col(f"m{i}").alias("value"),
        )
        for i, (check, subject, key, _) in enumerate(measures)
    ]
    return row.select(F.inline(F.array(*cells)))


def cell(table: str, check: str, subject: str, key: Column, value: Column) -> Column:
    """One row of a fingerprint as a struct."""
    names = (F.lit(table), F.lit(check), F.lit(subject), key.cast("string"), value)
    return F.struct(*[c.alias(n) for c, n in zip(names, FINGERPRINT, strict=True)])


def parent_profile(df: DataFrame, table: Table) -> list[DataFrame]:
    """Rows and money per parent: the only measure that sees rows under a wrong parent. The key of rows without one is NULL."""
    out = []
    for link in table.parents:
        grouped = df.groupBy(F.col(link.column).alias("parent")).agg(
            F.count(F.lit(1)).cast("string").alias("n"), *[exact_sum(c).cast("string").alias(f"s{i}") for i, c in enumerate(table.names("money"))]
        )
        out.append(grouped.select(F.inline(F.array(*_parent_cells(table, link.column, F.col("parent"), F.col("n"), lambda i: F.col(f"s{i}"))))))
    return out


def _parent_cells(table: Table, column: str, parent: Column, count: Column, money) -> list[Column]:
    rows = [cell(table.name, "parent_profile", f"{column}: rows", parent, count)]
    return rows + [cell(table.name, "parent_profile", f"{column}: {c}", parent, money(i)) for i, c in enumerate(table.names("money"))]


def value_counts(df: DataFrame, table: str, check: str, column: str) -> DataFrame:
    """Distinct values byte for byte with their counts."""
    return (
        df.groupBy(F.col(column).alias("v"))
        .agg(F.count(F.lit(1)).cast("string").alias("value"))
        .select(
            F.lit(table).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.lit(column).alias("subject"),
            F.col("v").cast("string").alias("key"),
            "value",
        )
    )


def unicode_sample(df: DataFrame, table: str, check: UnicodeCheck) -> DataFrame:
    """The matching texts, each with its number: no order, so no collation can disturb them."""
    hits = df.where(any_like(F.col(check.column), check.patterns))
    return value_counts(hits, table, "unicode_sample", check.column)


def table_fingerprint(df: DataFrame, table: Table, contract: Contract) -> DataFrame:
    """All measures of a table from one scan and one aggregate.

    The rows are grouped four ways at once, as grouping sets: not at all, by each parent,
    by the status and by the sampled text. Every task folds its rows before they move, so
    what is shuffled are group totals. Rows outside the text sample make one group that is
    dropped; the key of a NULL group is NULL. A row that does not count is added, because
    without any row the empty set would make no group.
    """
    case = contract.case_check if contract.case_check and contract.case_check.table == table.name else None
    uni = contract.unicode_check if contract.unicode_check and contract.unicode_check.table == table.name else None
    measures = scalar_measures(table, case, F.col("_real"))
    groups = [(f"_p{i}", F.col(p.column)) for i, p in enumerate(table.parents)]
    if case:
        groups.append(("_status", F.col(case.column)))
    if uni:
        groups.append(("_text", F.when(any_like(F.col(uni.column), uni.patterns), F.col(uni.column))))
    if not groups:
        return long_form(df, table.name, scalar_measures(table, case))
    one = df.sparkSession.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in df.dtypes], F.lit(False).alias("_real"))
    df = df.withColumn("_real", F.lit(True)).unionByName(one)
    names = [n for n, _ in groups]
    money = {c: i for i, (check, c, _, _) in enumerate(measures) if check == "money_sum"}
    counted = df.withColumns(dict(groups)).groupingSets([[], *[[F.col(n)] for n in names]], *names).agg(
        *[m.alias(f"m{i}") for i, (_, _, _, m) in enumerate(measures)], F.grouping_id().alias("_set")
    )
    whole = F.array(*[cell(table.name, check, subject, F.lit(key), F.col(f"m{i}")) for i, (check, subject, key, _) in enumerate(measures)])
    cells, last = F.when(F.col("_set") == 2 ** len(names) - 1, whole), len(names) - 1
    for at, name in enumerate(names):
        only = F.col("_set") == 2 ** len(names) - 1 - 2 ** (last - at)
        if name == "_status":
            found = [cell(table.name, "status_count", case.column, F.col(name), F.col("m0"))]
        elif name == "_text":
            only = only & F.col(name).isNotNull()
            found = [cell(table.name, "unicode_sample", uni.column, F.col(name), F.col("m0"))]
        else:
            own = table.names("money")
            found = _parent_cells(table, table.parents[at].column, F.col(name), F.col("m0"), lambda i, own=own: F.col(f"m{money[own[i]]}"))
        cells = cells.when(only, F.array(*found))
    return counted.where(f"_set = {2 ** len(names) - 1} OR m0 <> '0'").select(F.inline(cells))


def fingerprint(frames: dict[str, DataFrame], contract: Contract) -> DataFrame:
    """Fingerprint of every given table of the contract."""
    parts = [table_fingerprint(frames[t.name], t, contract) for t in contract.tables if t.name in frames]
    return reduce(DataFrame.unionByName, parts)


def write_fingerprint(profile: DataFrame, path: str) -> None:
    """JSON lines, non-ASCII as it is, decimals as text."""
    profile.write.mode("errorifexists").json(path)


def match_loss(df: DataFrame, column: str, value: str) -> DataFrame:
    """How many rows a byte-exact filter loses against a case-folding one."""
    c = F.col(column)
    counted = df.agg(
        F.count_if(folded(c, value)).alias("folded_rows"), F.count_if(exact(c, value)).alias("exact_rows")
    )
    lost = F.col("folded_rows") - F.col("exact_rows")
    share = lost.cast("decimal(20,0)") * 100 / F.when(F.col("folded_rows") > 0, F.col("folded_rows")).cast("decimal(20,0)")
    return counted.select(
        F.lit(value).alias("value"), "folded_rows", "exact_rows", lost.alias("lost_rows"),
        share.cast("decimal(7,4)").alias("lost_percent"),
    )


def case_groups(df: DataFrame, column: str) -> DataFrame:
    """Each spelling beside the folded group that hides it.

    Rows shrink to distinct spellings first; the folded totals are then sums over
    spellings, so no group is ever held whole.
    """
    spelled = df.groupBy(F.col(column).alias("spelling")).agg(F.count(F.lit(1)).alias("spelling_rows"))
    spelled = spelled.withColumn("folded", F.lower("spelling"))
    totals = spelled.groupBy("folded").agg(
        F.count(F.lit(1)).alias("spellings"), F.sum("spelling_rows").alias("folded_rows")
    )
    joined = spelled.alias("s").join(totals.alias("t"), F.col("s.folded").eqNullSafe(F.col("t.folded")))
    return joined.select("s.folded", "s.spelling", "s.spelling_rows", "t.spellings", "t.folded_rows")
