"""Where rows stand in a total order, without a task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.config import RAW_COLUMNS, fresh_dir

# Creation time, key (a missing key sorts as empty text), update time; the remaining columns only
# order rows that are equal in these, which makes a cut reproducible.
SOURCE_ORDER = ("created_date", "unique_key", "resolution_action_updated_date")

# Spark numbers the files of a write by task; the number has five digits or more.
_TASK = r"part-(\d+)"


def source_order() -> list[Column]:
    """A total order but for equal rows: texts, then which of them are missing."""
    columns = [*SOURCE_ORDER, *(c for c in RAW_COLUMNS if c not in SOURCE_ORDER)]
    missing = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return [*[F.coalesce(F.col(c), F.lit("")).asc() for c in columns], missing.asc()]


def with_positions(rows: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """The rows with their `position` in the given order, counted from 0.

    They are stored by ranges of the order, sorted inside. A position is the row's index in its file plus the rows
    of the files before, so no task sees more than its range. Files are ordered by task number and not by
    name, which sorts wrongly from 100,000 files on; the driver adds up one row a file. Rows equal in the
    order stand in any order among themselves. An empty table has no positions.
    """
    path = fresh_dir(rows.sparkSession, label)
    rows.orderBy(*order).write.option("compression", "zstd").parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path).select(
        "*",
        F.regexp_extract(F.col("_metadata.file_name"), _TASK, 1).cast("long").alias("_task"),
        F.col("_metadata.row_index").alias("_index"),
    )
    before, starts = 0, []
    for task, size in stored.groupBy("_task").count().orderBy("_task").collect():
        starts.append((task, before))
        before += size
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "_task bigint, _start bigint"))
    position = (F.col("_start") + F.col("_index")).alias("position")
    return stored.join(starts, "_task").select(*rows.columns, position)
