"""Exact duplicates: frequent digests leave by broadcast, the others meet in an ordinary shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import ascii_lower, documents, keep_rows, stored

SUPPORT = 1e-3
"""A digest that a larger share of the rows carries is frequent; 1 / SUPPORT bounds the broadcast."""


def normalised(text):
    return F.coalesce(ascii_lower(text), F.lit(""))


def _winners(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size")
    )


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT
) -> DataFrame:
    """One row per input row: doc_id, digest (binary SHA-256), keep_id, group_size, kept.

    Texts are equal when they agree after lower-casing A-Z. The row with the largest id stays; of
    rows that repeat this id one stays. A null text equals the empty one, a null id is smaller than
    any other, and an empty table gives an empty result. Other columns are not read.

    Misra-Gries counting (`freqItems`) over all rows names at most 1 / support candidates, among them
    every digest with a larger share. Their exact counts and winners are broadcast and settle
    their rows in the map side; the rest is aggregated before it is shuffled.
    """
    rows = stored(
        documents(docs, id_col, text_col).select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)).alias("digest"),
        ),
        "exact-digests",
    )
    candidates = rows.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    candidates = stored(candidates, "exact-candidates")
    total = rows.count()
    heavy = _winners(rows.join(F.broadcast(candidates), "digest", "left_semi"))
    heavy = stored(heavy.where(F.col("group_size") > support * total), "exact-heavy")

    settled = rows.join(F.broadcast(heavy), "digest")
    light = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    settled = settled.unionByName(light.join(_winners(light), "digest"))
    return settled.select(
        "doc_id",
        "digest",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Rows that repeat the winner's id and text become one."""
    groups = duplicate_groups(docs, id_col, text_col)
    digest = F.sha2(normalised(F.col(text_col)).cast("binary"), 256)
    kept = stored(groups.where("kept").select(F.col("keep_id"), F.hex("digest").alias("kept_digest")), "exact-kept")
    rows = keep_rows(docs, kept, ("keep_id", docs[id_col].cast("long")), ("kept_digest", F.upper(digest)))
    return rows.dropDuplicates([id_col, text_col])
