"""Service boundaries as column lists."""

from __future__ import annotations

from pyspark.sql import DataFrame

from proofline.contract import Contract, ContractError, Projection


def project(df: DataFrame, boundary: Projection) -> DataFrame:
    rows = df.where(boundary.where) if boundary.where else df
    return rows.select(*boundary.columns)


def publish(contract: Contract, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every declared projection as a frame and as a temporary view of that name."""
    out = {p.name: project(frames[p.table], p) for p in contract.projections if p.table in frames}
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    return out


def assert_published(df: DataFrame, boundary: Projection) -> None:
    """A published frame has exactly the agreed columns: one more is an API change."""
    if tuple(df.columns) != boundary.columns:
        raise ContractError(f"{boundary.name} publishes {df.columns}, agreed were {list(boundary.columns)}")
