"""Is the target complete, current and proven enough to switch over?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.contract import Contract


def coverage_gap(spark: SparkSession, contract: Contract, changes: DataFrame) -> DataFrame:
    """Declared tables the change log never mentions.

    Such a table is loaded once and then silently never changes again.
    """
    declared = spark.createDataFrame([(n,) for n in contract.names], "table_name string")
    return declared.join(changes.select("table_name").distinct(), "table_name", "left_anti")


def prove_arrival(state: DataFrame, key: dict[str, object], expected: dict[str, object]) -> DataFrame:
    """Whether the row with ``key`` arrived with exactly the ``expected`` values.

    One row: ``arrived``, ``matches`` and the key's row count. Compare money as Decimal.
    """
    row = state
    for name, value in key.items():
        row = row.where(F.col(name) == F.lit(value))
    same = F.lit(True)
    for name, value in expected.items():
        same = same & F.col(name).eqNullSafe(F.lit(value))
    return row.agg(
        (F.count(F.lit(1)) > 0).alias("arrived"),
        F.coalesce(F.bool_and(same), F.lit(False)).alias("matches"),
        F.count(F.lit(1)).alias("rows"),
    )


def cutover_gate(lag: DataFrame, checks: DataFrame, gaps: DataFrame, max_lag: float) -> DataFrame:
    """One row per condition; switching over needs all of them passed."""
    conditions = [
        lag.agg(F.max("max_lag").cast("string").alias("value"), F.coalesce(F.max("max_lag") <= max_lag, F.lit(False)).alias("passed")).select(
            F.lit("lag").alias("condition"), "value", F.lit(str(max_lag)).alias("wanted"), "passed"
        ),
        checks.where(F.col("failure_class") < 3)
        .agg(F.count_if(~F.col("passed")).alias("n"))
        .select(F.lit("verification").alias("condition"), F.col("n").cast("string").alias("value"), F.lit("0").alias("wanted"), (F.col("n") == 0).alias("passed")),
        gaps.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("coverage").alias("condition"), F.col("n").cast("string").alias("value"), F.lit("0").alias("wanted"), (F.col("n") == 0).alias("passed")
        ),
    ]
    return conditions[0].unionByName(conditions[1]).unionByName(conditions[2])
