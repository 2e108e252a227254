"""A corpus through five operators: toxicity, near duplicates, benchmark leaks, secrets, pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from proofline.llm import decontaminate, jaccard_join, pieces, secrets, toxicity
from proofline.llm.queries import toxicity_model
from proofline.llm.text import materialized, ship, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance rejects go."""
    ship(spark)
    return toxicity.without_toxic(docs, toxicity_model(docs, spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked texts the one with the smallest doc_id stays."""
    ship(spark)
    return jaccard_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    ship(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the pieces of every document."""
    ship(spark)
    return pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=False).drop("ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("pieces", encode),
]

#: No SQL here: compression, latent search and the encoding have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
