"""What the corpus operators share: stored tables, batch limits, text normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.config import fresh_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = 2**63 - 1
"""Stands for a null document id inside the operators; it sorts behind every other id."""

# Rows of one Arrow batch, and bytes where the session knows that limit: long texts then arrive in small batches.
BATCH_ROWS, BATCH_BYTES = 2048, 16 << 20


def arrow_batches(spark: SparkSession) -> None:
    """Bound what a Python worker receives at once. The settings stay with the session: plans are lazy and read them
    when they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a lost executor never reruns what made it."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z only; every other letter stays."""
    return F.translate(text, UPPER, LOWER)


def documents(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """The two columns an operator works on, under fixed names, whatever else the table holds."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)


def keep_rows(df: DataFrame, wanted: DataFrame, *keys: tuple[str, Column]) -> DataFrame:
    """Rows of df whose key columns (name in wanted, value in df) occur in wanted; nulls equal nulls."""
    match = None
    for name, value in keys:
        same = value.eqNullSafe(wanted[name])
        match = same if match is None else match & same
    return df.join(wanted, match, "left_semi")
