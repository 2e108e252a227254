"""The verification gate: every check is rows, every row knows what to do about it.

A row is (check_name, failure_class, table_name, subject, key, source_value,
target_value, passed, response). ``passed`` is NULL for a check the contract does
not ask for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.contract import Contract, Table
from proofline.operators.compare import anchor_diff, fingerprint_diff
from proofline.operators.fingerprint import NO_KEY
from proofline.operators.orphans import reconcile_orphans

# What a failure of each class calls for (fixed values).
RESPONSES = {
    0: "fix ingestion, reload the source",
    1: "fix, wipe and reload",
    2: "fix the mapping, wipe and reload",
    3: "decide; reloading changes nothing",
}

# Class of each check (fixed values).
CLASSES = {
    "anchor": 0,
    "row_count": 1,
    "orphans": 1,
    "money_sum": 2,
    "date_range": 2,
    "null_count": 2,
    "parent_profile": 2,
    "unicode_sample": 2,
    "next_key": 2,
    "generated": 2,
    "status_count": 3,
    "match_count": 3,
    "case_variant": 3,
}

CHECK = ["check_name", "failure_class", "table_name", "subject", "key", "source_value", "target_value", "passed", "response"]
COMPARED = ("row_count", "money_sum", "date_range", "null_count", "parent_profile", "unicode_sample", "status_count")


class GateClosed(AssertionError):
    """Verification failed; nothing may go live."""


def _by_name(check: Column, values: dict) -> Column:
    """Look a check's attribute up without a join."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[check]


def with_class(df: DataFrame) -> DataFrame:
    """Add failure class and response to rows that carry a check name."""
    classed = df.withColumn("failure_class", _by_name(F.col("check_name"), CLASSES).cast("int"))
    return classed.withColumn("response", _by_name(F.col("failure_class"), RESPONSES))


def _check(df: DataFrame) -> DataFrame:
    return with_class(df).select(*CHECK)


def _row(spark: SparkSession, check: str, table: str, subject: str, passed: bool | None, source=None, target=None) -> DataFrame:
    df = spark.range(1).select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.lit(subject).alias("subject"),
        F.lit(NO_KEY).alias("key"), F.lit(source).cast("string").alias("source_value"),
        F.lit(target).cast("string").alias("target_value"), F.lit(passed).cast("boolean").alias("passed"),
    )
    return _check(df)


def skipped(spark: SparkSession, check: str) -> DataFrame:
    return _row(spark, check, "*", "*", None)


def only(profile: DataFrame, *names: str) -> DataFrame:
    """The rows of some checks; taken before two fingerprints meet, so that the others do not move."""
    return profile.where(F.col("check_name").isin(*names))


def fingerprint_checks(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts, sums, ranges, NULLs, parents, texts and statuses of two fingerprints."""
    compared = fingerprint_diff(only(source, *COMPARED), only(target, *COMPARED), only_differences=False)
    return _check(compared.withColumnRenamed("same", "passed"))


def unicode_present(source: DataFrame, contract: Contract) -> DataFrame:
    """A sample without a single hit proves nothing and fails."""
    uni = contract.unicode_check
    hits = source.where(F.col("check_name") == "unicode_sample").agg(
        F.coalesce(F.sum(F.col("value").cast("bigint")), F.lit(0)).alias("hits")
    )
    return _check(
        hits.select(
            F.lit("unicode_sample").alias("check_name"), F.lit(uni.table).alias("table_name"),
            F.lit(f"{uni.column}: present").alias("subject"), F.lit(NO_KEY).alias("key"),
            F.col("hits").cast("string").alias("source_value"), F.lit(None).cast("string").alias("target_value"),
            (F.col("hits") > 0).alias("passed"),
        )
    )


def match_checks(source: DataFrame, target: DataFrame, contract: Contract) -> DataFrame:
    """The meaning of the filter changed exactly as expected.

    Folded and exact counts agree on both sides, and the exact filter does lose rows:
    a difference that reloading cannot remove and that must not vanish unnoticed.
    """
    case = contract.case_check

    tagged = source.withColumn("side", F.lit("s")).unionByName(target.withColumn("side", F.lit("t")))

    def count(side: str, key: str) -> Column:
        hit = (F.col("side") == side) & (F.col("key") == key)
        return F.max(F.when(hit, F.col("value").cast("bigint"))).alias(f"{side}_{key}")

    both = tagged.where(F.col("check_name") == "match_count").agg(
        *[count(side, key) for side in ("s", "t") for key in ("folded", "exact")]
    )
    lost = F.col("s_folded") - F.col("t_exact")
    cells = [
        ("folded", F.col("s_folded"), F.col("t_folded"), F.col("s_folded").eqNullSafe(F.col("t_folded"))),
        ("exact", F.col("s_exact"), F.col("t_exact"), F.col("s_exact").eqNullSafe(F.col("t_exact"))),
        ("lost", F.col("s_folded"), lost, F.coalesce(lost > 0, F.lit(False))),
    ]
    rows = both.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("key"), s.cast("string").alias("source_value"),
                        t.cast("string").alias("target_value"), ok.alias("passed"),
                    )
                    for k, s, t, ok in cells
                ]
            )
        )
    )
    return _check(
        rows.withColumns(
            {"check_name": F.lit("match_count"), "table_name": F.lit(case.table), "subject": F.lit(case.column)}
        )
    )


def variant_checks(target: DataFrame, contract: Contract) -> DataFrame:
    """Every declared spelling still occurs: none was dropped or normalised on the way.

    ``target`` is the fingerprint, which already counted every spelling.
    """
    case = contract.case_check
    seen = target.where(F.col("check_name") == "status_count")
    count = lambda v: F.coalesce(F.max(F.when(F.col("key") == v, F.col("value").cast("bigint"))), F.lit(0))
    row = seen.agg(*[count(v).alias(f"v{i}") for i, v in enumerate(case.variants)])
    cells = [
        F.struct(F.lit(v).alias("key"), F.col(f"v{i}").cast("string").alias("target_value"), (F.col(f"v{i}") > 0).alias("passed"))
        for i, v in enumerate(case.variants)
    ]
    return _check(
        row.select(F.inline(F.array(*cells))).withColumns(
            {
                "check_name": F.lit("case_variant"), "table_name": F.lit(case.table),
                "subject": F.lit(case.column), "source_value": F.lit(None).cast("string"),
            }
        )
    )


def orphan_checks(target: dict[str, DataFrame], contract: Contract) -> DataFrame:
    counts = reconcile_orphans(contract, target)
    return _check(
        counts.select(
            F.lit("orphans").alias("check_name"), F.split("check_name", r"\.")[0].alias("table_name"),
            F.col("check_name").alias("subject"), F.lit(NO_KEY).alias("key"), F.lit(None).cast("string").alias("source_value"),
            F.col("orphan_count").cast("string").alias("target_value"), (F.col("orphan_count") == 0).alias("passed"),
        )
    )


def generated_check(df: DataFrame, table: Table) -> DataFrame:
    """Every generated column is present and equals its expression, recomputed."""
    made = [c for c in table.columns if c.generated]
    expected = {c.name: F.expr(c.expr).try_cast(c.spark_type) for c in made}
    row = df.agg(
        *[F.count_if(F.col(n).isNull()).alias(f"{n}_null") for n in expected],
        *[F.count_if(~F.col(n).eqNullSafe(e)).alias(f"{n}_wrong") for n, e in expected.items()],
    )
    cells = [
        F.struct(
            F.lit(n).alias("subject"), F.lit(k).alias("key"), F.col(f"{n}_{k}").cast("string").alias("target_value"),
            (F.col(f"{n}_{k}") == 0).alias("passed"),
        )
        for n in expected
        for k in ("null", "wrong")
    ]
    return _check(
        row.select(F.inline(F.array(*cells))).withColumns(
            {
                "check_name": F.lit("generated"), "table_name": F.lit(table.name),
                "source_value": F.lit(None).cast("string"),
            }
        )
    )


def next_key_checks(target: DataFrame, contract: Contract, next_keys: dict[str, int]) -> DataFrame:
    """The next key to be handed out lies above every key in use.

    ``target`` is the target's fingerprint, so no table is scanned again.
    """
    given = F.create_map(*[F.lit(x) for n, k in next_keys.items() for x in (n, int(k))])[F.col("table_name")]
    marks = target.where((F.col("check_name") == "max_key") & F.col("table_name").isin(*next_keys))
    return _check(
        marks.select(
            F.lit("next_key").alias("check_name"), "table_name", "subject", F.lit(NO_KEY).alias("key"),
            given.cast("string").alias("source_value"), F.col("value").alias("target_value"),
            F.coalesce(F.col("value").cast("bigint") < given, F.lit(True)).alias("passed"),
        )
    )


def anchor_checks(original: DataFrame, source: DataFrame, table: Table, column: str) -> DataFrame:
    """The source itself agrees with the file it was loaded from: one failed row per key, or one passed row if there is none."""
    found = anchor_diff(original, source, table, column)
    total = found.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("anchor").alias("check_name"), F.lit(table.name).alias("table_name"), F.lit(f"{column}: rows that differ").alias("subject"),
        F.lit(NO_KEY).alias("key"), F.lit("0").alias("source_value"), F.col("n").cast("string").alias("target_value"), (F.col("n") == 0).alias("passed"),
    )
    rows = found.select(
        F.lit("anchor").alias("check_name"), "table_name", F.lit(column).alias("subject"), F.col("row_key").alias("key"),
        F.col("file_value").alias("source_value"), F.col("table_value").alias("target_value"), F.lit(False).alias("passed"),
    )
    return _check(rows.unionByName(total.where("passed")))


def verify(
    contract: Contract,
    source: dict[str, DataFrame],
    target: dict[str, DataFrame],
    source_print: DataFrame,
    target_print: DataFrame,
    original: DataFrame | None = None,
    next_keys: dict[str, int] | None = None,
) -> DataFrame:
    """All checks the contract asks for, as one frame.

    The fingerprints are read several times: pass them written or checkpointed.
    ``original`` is the file the source's unicode-checked table was loaded from.
    """
    spark = source_print.sparkSession
    parts = [fingerprint_checks(source_print, target_print), orphan_checks(target, contract)]
    for t in contract.tables:
        if t.name in target and any(c.generated and c.expr for c in t.columns):
            parts.append(generated_check(target[t.name], t))
    if next_keys:
        parts.append(next_key_checks(target_print, contract, next_keys))
    if contract.case_check:
        parts.append(match_checks(source_print, target_print, contract))
        if contract.case_check.variants:
            parts.append(variant_checks(target_print, contract))
    else:
        parts += [skipped(spark, "match_count"), skipped(spark, "case_variant")]
    if contract.unicode_check:
        parts.append(unicode_present(source_print, contract))
    else:
        parts.append(skipped(spark, "unicode_sample"))
    if original is not None and contract.unicode_check:
        uni = contract.unicode_check
        parts.append(anchor_checks(original, source[uni.table], contract.table(uni.table), uni.column))
    else:
        parts.append(skipped(spark, "anchor"))
    return reduce(DataFrame.unionByName, parts)


def summary(checks: DataFrame) -> DataFrame:
    """Per check: how many rows passed, failed and were skipped."""
    return checks.groupBy("check_name", "failure_class", "response").agg(
        F.count_if(F.col("passed")).alias("passed_rows"),
        F.count_if(~F.col("passed")).alias("failed_rows"),
        F.count_if(F.col("passed").isNull()).alias("skipped_rows"),
    )


def gate(checks: DataFrame, shown: int = 20) -> DataFrame:
    """Raise when a check of class 0 to 2 failed; return the class 3 findings.

    The message shows the first failures and the count of all of them.
    """
    failed = checks.where(~F.col("passed"))
    blocking = failed.where(F.col("failure_class") < 3)
    worst = blocking.orderBy("failure_class", "check_name", "table_name", "subject", "key").limit(shown).collect()
    if worst:
        total = blocking.count()
        lines = [
            f"  [{r.failure_class}] {r.check_name} {r.table_name}.{r.subject} {r.key}: "
            f"{r.source_value} -> {r.target_value} ({r.response})"
            for r in worst
        ]
        raise GateClosed(f"{total} failed checks\n" + "\n".join(lines))
    return failed.where(F.col("failure_class") == 3)


def snapshot_compare(restored: DataFrame, live: DataFrame) -> DataFrame:
    """A restored copy against the live one: counts and sums of two fingerprints."""
    wanted = ("row_count", "money_sum")
    both = fingerprint_diff(only(restored, *wanted), only(live, *wanted), only_differences=False)
    return both.select(
        "table_name", "check_name", "subject", F.col("source_value").alias("restored_value"),
        F.col("target_value").alias("live_value"), "same",
    )


def side_by_side(source: DataFrame, target: DataFrame) -> DataFrame:
    """Both sides of the ungrouped measures next to each other, with the money difference."""
    wanted = ("row_count", "money_sum", "match_count")
    both = fingerprint_diff(only(source, *wanted), only(target, *wanted), only_differences=False)
    total = "decimal(38,4)"
    return both.select(
        "table_name", "check_name", "subject", "key", "source_value", "target_value", "same",
        (F.col("target_value").cast(total) - F.col("source_value").cast(total)).cast(total).alias("delta"),
    )
