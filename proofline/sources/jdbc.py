"""Relational read: the stored columns of a table, split on its key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from proofline.contract import Contract, Table

FETCH_ROWS = 5000  # rows per round trip


def projection(table: Table) -> str:
    """Select list: generated columns stay out, uuids cross as text.

    The byte order of a uuid differs between databases, its text does not.
    """
    return ", ".join(
        f"CAST({c.name} AS VARCHAR(36)) AS {c.name}" if c.type == "uuid" else c.name for c in table.stored
    )


def custom_schema(table: Table) -> str:
    """Types the reader must not choose itself; money stays a 4-decimal decimal."""
    kinds = {"money": "DECIMAL(19,4)", "uuid": "STRING", "text": "STRING", "char": "STRING"}
    return ", ".join(f"{c.name} {kinds[c.type]}" for c in table.stored if c.type in kinds)


def read_options(
    contract: Contract,
    name: str,
    url: str,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of ``spark.read.format('jdbc')``; with bounds the scan runs in parallel."""
    table = contract.table(name)
    options = {
        "url": url,
        "dbtable": f"(SELECT {projection(table)} FROM {contract.source_schema}.{table.name}) t",
        "fetchsize": str(FETCH_ROWS),
        "customSchema": custom_schema(table),
        "preferTimestampNTZ": "true",
    }
    if bounds is not None:
        if table.column(table.key).type not in ("int", "bigint"):
            raise ValueError(f"{name}: key {table.key} is not a whole number and cannot split the read")
        options.update(
            partitionColumn=table.key,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1] + 1),
            numPartitions=str(partitions),
        )
    return {**options, **(extra or {})}


def key_bounds(spark: SparkSession, contract: Contract, name: str, url: str, extra: dict[str, str] | None = None) -> tuple[int, int] | None:
    """Smallest and largest key, one row computed by the database."""
    table = contract.table(name)
    query = f"SELECT MIN({table.key}) AS lo, MAX({table.key}) AS hi FROM {contract.source_schema}.{table.name}"
    row = spark.read.format("jdbc").options(url=url, query=query, **(extra or {})).load().first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def read_jdbc(
    spark: SparkSession,
    contract: Contract,
    name: str,
    url: str,
    partitions: int = 32,
    extra: dict[str, str] | None = None,
) -> DataFrame:
    bounds = key_bounds(spark, contract, name, url, extra) if partitions > 1 else None
    options = read_options(contract, name, url, bounds, partitions, extra)
    return spark.read.format("jdbc").options(**options).load()
