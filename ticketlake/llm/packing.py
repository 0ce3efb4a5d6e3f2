"""Packing: length buckets that minimise padding, and batches of a token budget inside each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.common import stored

# Tokens of a sequence and of a batch (padding included) at most, buckets, and sequences numbered by one task.
CONTEXT, BATCH_TOKENS, BUCKETS, RUN_ROWS = 8192, 1 << 18, 16, 1_000_000


def byte_tokens(text_col: str = "text") -> Column:
    """Length for a byte-level vocabulary: one token a UTF-8 byte, none for a null text."""
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Ascending bucket lengths, at most `buckets`, with the least padding of all choices.

    lengths: distinct and ascending. least[i] is the least padding of the first i lengths in so many
    buckets; where the last bucket begins moves only up with i, so halves are solved between their bounds.
    """
    n = len(lengths)
    rows = np.concatenate([[0], np.cumsum(counts, dtype=float)])
    tokens = np.concatenate([[0], np.cumsum(lengths * counts, dtype=float)])
    least = np.concatenate([[0.0], np.full(n, np.inf)])
    begins = []
    for _ in range(min(buckets, n)):
        now, begin = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        now[0] = 0.0
        open_ = [(1, n, 0, n - 1)]
        while open_:
            low, high, first, last = open_.pop()
            if low > high:
                continue
            mid = (low + high) // 2
            j = np.arange(first, min(mid - 1, last) + 1)
            cost = least[j] + lengths[mid - 1] * (rows[mid] - rows[j]) - (tokens[mid] - tokens[j])
            at = int(cost.argmin())
            now[mid], begin[mid] = cost[at], j[at]
            open_ += [(low, mid - 1, first, begin[mid]), (mid + 1, high, begin[mid], last)]
        least = now
        begins.append(begin)
    out, end = [], n
    for begin in reversed(begins):
        if not end:
            break
        out.append(int(lengths[end - 1]))
        end = int(begin[end])
    return out[::-1]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    tokens: Column | None = None,
    context: int = CONTEXT,
    batch_tokens: int = BATCH_TOKENS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per sequence: doc_id, piece, start, n_tokens, bucket (its length), batch, slot, padding.

    `tokens` counts the tokens of a row (default: byte_tokens()). A row longer than the context becomes pieces
    that cover it; one without tokens is a piece of length 0. Bucket lengths come from the histogram of
    all pieces, which has `context` + 1 entries at most; the choice is optimal for the given number. A
    batch holds as many sequences of one bucket as fit its budget when padded to the bucket's length;
    only the last batch of a bucket may hold fewer. Sequences of a bucket are numbered without gaps.

    Null ids and repeated rows are sequences like any other; an empty table gives an empty result.
    Other columns are not read.
    """
    if context < 1 or batch_tokens < context or buckets < 1:
        raise ValueError("a batch must hold a whole context, and there must be a bucket")
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        (byte_tokens() if tokens is None else tokens).cast("long").alias("whole"),
    )
    last = F.greatest(F.lit(0), F.ceil(F.col("whole") / context) - 1).cast("int")
    pieces = rows.select("row", "doc_id", "whole", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * context
    pieces = pieces.select(
        "row", "doc_id", "piece", start.alias("start"), F.least(F.lit(context), F.col("whole") - start).alias("n_tokens")
    )
    pieces = stored(pieces, "pack-pieces")
    histogram = sorted(pieces.groupBy("n_tokens").count().collect())
    counts = np.array([r["count"] for r in histogram], float)
    limits = boundaries(np.array([r["n_tokens"] for r in histogram], float), counts, buckets) or [0]

    bucket = F.lit(limits[-1])
    for limit in reversed(limits[:-1]):
        bucket = F.when(F.col("n_tokens") <= limit, limit).otherwise(bucket)
    runs = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(counts.sum()) // RUN_ROWS))
    run = F.pmod(F.xxhash64("row", "piece"), F.lit(runs)).cast("int")
    placed = pieces.select("*", bucket.cast("long").alias("bucket"), run.alias("run"))
    before, offsets = dict.fromkeys(limits, 0), []
    for r in sorted(placed.groupBy("bucket", "run").count().collect()):
        offsets.append((r["bucket"], r["run"], before[r["bucket"]]))
        before[r["bucket"]] += r["count"]
    offsets = F.broadcast(spark.createDataFrame(offsets, "bucket long, run int, before long"))
    order = Window.partitionBy("bucket", "run").orderBy("doc_id", "piece", "n_tokens", "row")
    numbered = placed.withColumn("nth", F.row_number().over(order)).join(offsets, ["bucket", "run"])
    fit = F.floor(F.lit(batch_tokens) / F.greatest(F.col("bucket"), F.lit(1)))
    at = F.col("before") + F.col("nth") - 1
    return numbered.select(
        "doc_id",
        "piece",
        "start",
        "n_tokens",
        "bucket",
        F.floor(at / fit).alias("batch"),
        (at % fit).alias("slot"),
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )
