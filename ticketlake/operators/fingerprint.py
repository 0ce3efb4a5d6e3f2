"""Content id of a set of raw rows that does not depend on their order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.config import RAW_COLUMNS

_PART = (1 << 21) - 1


def json_line() -> Column:
    """The row as JSON: columns in name order, missing ones left out."""
    return F.to_json(F.struct(*sorted(RAW_COLUMNS)), {"ignoreNullFields": "true"})


def row_digest(line: Column | None = None) -> Column:
    """SHA-256 of the row's JSON line, which may be at hand."""
    return F.sha2(json_line() if line is None else line, 256)


def _unsigned_sum(bits: Column) -> Column:
    """Aggregate: the exact sum of 64-bit numbers without sign. Rows add up three parts of them as plain integers, which
    hold the parts of 2^41 rows; only the sums are decimals."""
    parts = [F.shiftrightunsigned(bits, 42), F.shiftright(bits, 21).bitwiseAND(_PART), bits.bitwiseAND(_PART)]
    high, middle, low = (F.sum(p).cast("decimal(20,0)") for p in parts)
    unit = F.lit(_PART + 1).cast("decimal(7,0)")
    return ((high * unit + middle).cast("decimal(30,0)") * unit + low).cast("decimal(38,0)")


def batch_id(digest: Column) -> Column:
    """Aggregate: a letter and 16 hex digits over the multiset of row digests.

    The four 64-bit quarters of the digests are summed exactly, so map-side partial sums combine
    in any order and a repeated row changes the id. The letter keeps partition values text.
    """
    quarters = [_unsigned_sum(F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("bigint")) for i in range(4)]
    parts = [F.count(digest).cast("string"), *[q.cast("string") for q in quarters]]
    return F.concat(F.lit("b"), F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 16))


def fingerprint(raw: DataFrame) -> DataFrame:
    """One row: the batch id and the row count."""
    digests = raw.select(row_digest().alias("digest"))
    return digests.agg(
        F.when(F.count("digest") > 0, batch_id(F.col("digest"))).alias("batch_id"),
        F.count("digest").alias("rows"),
    )
