"""Delimited text with a declared layout and a declared encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from proofline.contract import ContractError, Table
from proofline.functions.conform import CORRUPT


def read_delimited(
    spark: SparkSession, path: str | list[str], table: Table, encoding: str = "UTF-8", sep: str = "|"
) -> DataFrame:
    """Positional, unquoted, headerless fields, all as strings; an empty field is NULL.

    Parsing is left to ``conform``: a reader given a decimal schema would cut
    ``1.00001`` to ``1.0000`` without an error. Lines with the wrong number of
    fields keep their text in ``_corrupt_line``. UTF-16 is only read whole by the
    ``multiLine`` reader, which takes one task per file, so large UTF-16 exports
    should come as many files; UTF-8 files are split.
    """
    if not encoding:
        raise ContractError("the encoding must be declared; it is never guessed")
    layout = T.StructType(table.text_struct().fields + [T.StructField(CORRUPT, T.StringType(), True)])
    reader = (
        spark.read.schema(layout)
        .option("sep", sep)
        .option("quote", "")
        .option("escape", "")
        .option("header", "false")
        .option("nullValue", "")
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")
        .option("multiLine", str(encoding.upper().startswith("UTF-16")).lower())
    )
    return reader.csv(path)
