"""Exact interpolated quantiles per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How often each value occurs per group: the only pass over the rows.

    Counts are combined before the shuffle and the shuffle spreads a group over all its values.
    `bucket` is the whole part of the value. A missing value is stored as NaN.
    """
    known = F.coalesce(F.col(value), F.lit(float("nan")))
    return (
        df.groupBy(*keys, known.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", F.floor("value"))
    )


def grouped_summary(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], digits: int = 4
) -> DataFrame:
    """Per group: `rows`, `mean`, and an exact, linearly interpolated quantile per entry of `probs`.

    A group's running totals over whole-number buckets tell which buckets hold the wanted ranks;
    only the values of those are then ranked, bucket by bucket. What one task sees of a group is
    its distinct buckets, then its distinct values in one bucket, however many rows it has.

    `value` has at most `digits` decimals; the mean is summed as a decimal, so it does not depend
    on the order in which partitions arrive. Missing values count in `rows` only.
    """
    keys = list(keys)
    counts = value_counts(df, keys, value)
    present = F.when(F.isnan("value"), F.lit(0)).otherwise(F.col("n"))
    exact = F.when(~F.isnan("value"), F.col("value")).cast(f"decimal(18,{digits})")
    buckets = counts.groupBy(*keys, "bucket").agg(
        F.sum("n").alias("all_rows"),
        F.sum(present).alias("in_bucket"),
        F.sum(exact * F.col("n").cast("decimal(18,0)")).alias("bucket_sum"),
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        buckets.withColumn("before", F.sum("in_bucket").over(upto) - F.col("in_bucket"))
        .withColumn("rows", F.sum("all_rows").over(group))
        .withColumn("total", F.sum("in_bucket").over(group))
        .withColumn("group_sum", F.sum("bucket_sum").over(group).cast("double"))
    )
    ranks = {n: (F.col("total") - 1).cast("double") * F.lit(float(p)) for n, p in probs.items()}
    after = F.col("before") + F.col("in_bucket")
    holds_rank = [
        (end >= F.col("before")) & (end < after)
        for r in ranks.values()
        for end in (F.floor(r), F.ceil(r))
    ]
    empty = F.col("total") == 0
    wanted = placed.filter(reduce(lambda a, b: a | b, holds_rank, empty)).drop(
        "all_rows", "in_bucket", "bucket_sum"
    )

    in_order = (
        Window.partitionBy(*keys, "bucket")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = (
        _join_null_safe(counts, wanted, [*keys, "bucket"])
        .withColumn("end", F.col("before") + F.sum(present).over(in_order))
        .withColumn("start", F.col("end") - present)
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("start")) & (rank < F.col("end")), F.col("value")))

    picks = [F.max(c).alias(c) for c in ("rows", "total", "group_sum")]
    for name, rank in ranks.items():
        picks.append(value_at(F.floor(rank)).alias(f"{name}_low"))
        picks.append(value_at(F.ceil(rank)).alias(f"{name}_high"))

    def interpolate(name: str) -> Column:
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        share = ranks[name] - F.floor(ranks[name])
        between = (F.lit(1.0) - share) * low + share * high
        return F.when(low == high, low).otherwise(between).alias(name)

    mean = F.when(~empty, F.col("group_sum") / F.col("total").cast("double")).alias("mean")
    return (
        ranked.groupBy(*keys)
        .agg(*picks)
        .select(*keys, "rows", mean, *[interpolate(n) for n in probs])
    )


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join on keys that may be NULL; keeps the left side's key columns.

    A plain equality would also add a not-null filter below the left side's aggregate, and the two
    uses of the value counts would no longer share their shuffle.
    """
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    return left.join(other, reduce(lambda a, b: a & b, on)).drop(*[f"_r_{c}" for c in keys])
