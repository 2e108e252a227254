"""High-water marks and key allocation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proofline.session import scratch


def high_water(df: DataFrame, key: str) -> int:
    """Largest key in use, 0 for an empty table: one aggregated row."""
    return int(df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).first()[0])


def allocate_keys(df: DataFrame, key: str, natural: list[str], above: int) -> DataFrame:
    """Number rows ``above + 1, above + 2, …`` without gaps, in the order of their natural key (NULLs first).

    Rows are dealt by ranges of the natural key, as many as the session's shuffle
    partitions, and written once, so that a repeated task cannot draw other borders. Each
    range is numbered by itself and shifted by the sizes of the ranges before it; only
    these sizes pass through one task. Reading a natural key that occurs twice raises.
    """
    spark = df.sparkSession
    if "_range" in df.columns or key in df.columns:
        raise ValueError(f"the rows have a column _range or {key} already")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark, "numbered")
    df.repartitionByRange(parts, *natural).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema(f"{_ddl(df)}, _range int").parquet(path)
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*natural)
    name = F.struct(*natural)
    # equal keys lie in one range, so neighbours tell
    again = name.eqNullSafe(F.lag(name).over(inside)) & (F.row_number().over(inside) > 1)
    number = F.when(again, F.raise_error(F.lit(f"the natural key {', '.join(natural)} is not unique")).cast("bigint")).otherwise(F.row_number().over(inside))
    numbered = dealt.withColumn("_inside", number).join(F.broadcast(offsets), "_range")  # at most `parts` rows
    return numbered.withColumn(key, (F.lit(above) + F.col("_offset") + F.col("_inside")).cast("bigint")).drop("_range", "_inside", "_offset")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def next_key_status(df: DataFrame, table: str, key: str, next_key: int) -> DataFrame:
    """Whether the allocator's next key would collide with a row that exists."""
    return df.agg(
        F.lit(table).alias("table_name"),
        F.max(key).cast("bigint").alias("max_key"),
        F.lit(next_key).cast("bigint").alias("next_key"),
        (F.coalesce(F.max(key), F.lit(next_key - 1)) >= F.lit(next_key)).alias("collides"),
    )


def with_new_guids(df: DataFrame, column: str, natural: list[str]) -> DataFrame:
    """Give rows without an identifier one that follows from their natural key.

    A random identifier would change when a lost task is repeated; this one does not.
    """
    h = F.md5(F.to_json(F.struct(*natural)))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    made = F.concat_ws("-", *[F.substring(h, at, n) for at, n in cuts])
    return df.withColumn(column, F.coalesce(F.col(column), made))
