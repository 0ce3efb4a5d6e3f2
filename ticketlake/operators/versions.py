"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_versions(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    tie_break: Sequence[str] = (),
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Keep the row with the highest `order` per key (NULL lowest); keep every row without a key.

    `row_number() == 1` lets Spark cut every key to one row per task before the shuffle, so a key
    that holds a third of the data ships one row per task. Rows without a key must neither meet in
    one task nor be dropped: they are windowed under an identity of their own, in the same pass. That is
    `row_id` (columns that identify a stored row, such as file path and row index) or else an id
    that is unique among the rows of this pass.

    The identity is not part of the result.
    """
    if not row_id:
        df, row_id = df.withColumn("_own", F.monotonically_increasing_id()), ("_own",)
    identity = [F.when(F.col(key).isNull(), F.col(c)) for c in row_id]
    return _first(df, [F.col(key), *identity], (*order, *tie_break)).drop(*row_id)


def latest_keyed(df: DataFrame, key: str, order: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """`latest_versions` of the rows with a key; they are left partitioned by it, as a join on the key needs them."""
    return _first(df.filter(F.col(key).isNotNull()), [F.col(key)], (*order, *tie_break))


def _first(df: DataFrame, group: Sequence[Column], order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_version", F.row_number().over(window)).filter(F.col("_version") == 1).drop("_version")


def newer(left: DataFrame, right: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Of two tables with a row a key: for each key that both have, the row with the higher `order` (NULL lowest)."""
    columns = left.columns
    both = left.select(key, F.struct(*order).alias("_left"), F.struct(*columns).alias("_left_row")).join(
        right.select(key, F.struct(*order).alias("_right"), F.struct(*columns).alias("_right_row")), key
    )
    won = F.when(F.col("_right") > F.col("_left"), F.col("_right_row")).otherwise(F.col("_left_row"))
    return both.select(won.alias("_row")).select("_row.*")
