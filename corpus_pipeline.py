"""A corpus pipeline over `documents`: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.config import fresh_dir
from ticketlake.llm import exact, packing, quality, simhash, suffix_dedup
from ticketlake.llm.queries import DISTANCE, QUALITY_THRESHOLD, REPEAT_BYTES, SHINGLE, quality_model


def _free_name(docs: DataFrame, name: str) -> str:
    """A column name that the table doesn't have, in any spelling."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the threshold stay; the labels are those of the source tables.

    A null text scores like the empty one, repeated rows and equal texts share a verdict, an empty table stays
    empty. All columns stay, whatever their names.
    """
    score = _free_name(docs, "quality_score")
    scored = quality.score(docs, quality_model(spark, sf_dir), score_col=score)
    return scored.where(F.col(score) >= QUALITY_THRESHOLD).drop(score)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays. A null text equals the empty one; of rows that share id and
    text one stays. An empty table stays empty, and so do all columns."""
    return exact.drop_duplicates(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked fingerprints the document with the smallest id stays. Null and empty texts and such
    without words have the fingerprint zero and are one group. An empty table stays empty, and so do all columns."""
    return simhash.drop_near_duplicates(docs, SHINGLE, DISTANCE)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that start earlier are cut out of the texts. Every row stays, also an emptied one; a null text becomes
    the empty one. `n_chars` follows the text; the other columns stay. An empty table stays empty."""
    cut = suffix_dedup.without_repeats(docs, length=REPEAT_BYTES)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of byte tokens with their length bucket and batch."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", simhash_stage),
    ("suffix-array dedup", suffix_stage),
    ("packing", packing_stage),
]

# The stages learn a model and compare bits, which SQL doesn't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
