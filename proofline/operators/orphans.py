"""Children without a parent, per declared edge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.contract import Contract


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign key values without a parent and the rows that carry them.

    Children are counted per key before the join, so a parent with most of the
    children costs one row. A NULL foreign key has no parent either.
    """
    used = child.groupBy(F.col(fk).alias("fk")).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(parent.select(F.col(pk).alias("fk")), "fk", "left_anti")


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str, label: str) -> DataFrame:
    """One row even when nothing is orphaned."""
    return orphan_keys(child, fk, parent, pk).agg(
        F.lit(label).alias("check_name"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphan_count")
    )


def reconcile_orphans(contract: Contract, frames: dict[str, DataFrame]) -> DataFrame:
    """(check_name, orphan_count) for every edge whose two tables are given."""
    counts = [
        orphan_count(
            frames[child.name], link.column, frames[parent.name], parent.key,
            f"{child.name}.{link.column} without {parent.name}",
        )
        for child, link, parent in contract.edges()
        if child.name in frames and parent.name in frames
    ]
    return reduce(DataFrame.unionByName, counts)
