"""Windows, order, limits and high-water marks over raw records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.config import RAW_COLUMNS, LakeConfig
from ticketlake.functions.casts import ntz, to_timestamp
from ticketlake.operators.page_index import PageIndex
from ticketlake.operators.positions import SOURCE_ORDER, source_order, with_positions


def created_at() -> Column:
    return to_timestamp(F.col("created_date"))


def in_window(raw: DataFrame, since, until=None) -> DataFrame:
    """Rows created after `since` (exclusive) and up to `until` (inclusive, optional).

    A row whose creation time cannot be read is in no window. Readable times begin with four digits of a
    year, so the year bounds the text as well; that bound reaches the files, which a cast cannot.
    """
    text = F.col("created_date")
    rows = raw.filter((created_at() > ntz(since)) & (text >= str(since)[:4]))
    if until is None:
        return rows
    next_year = int(str(until)[:4]) + 1
    rows = rows.filter(created_at() <= ntz(until))
    return rows if next_year > 9999 else rows.filter(text < f"{next_year:04d}")


def first_n(raw: DataFrame, n: int) -> DataFrame:
    """The oldest n rows."""
    return raw.orderBy(*source_order()).limit(n)


def numbered(raw: DataFrame, row_id: Sequence[str] = ()) -> DataFrame:
    """Raw rows with their `position` in the source order, counted from 0.

    `row_id` columns tell equal rows apart, so that many copies of a row spread over several files.
    """
    rows = raw.select(*RAW_COLUMNS, *row_id)
    return with_positions(rows, [*source_order(), *map(F.col, row_id)], "numbered").select(*RAW_COLUMNS, "position")


def page(raw: DataFrame, offset: int, size: int) -> DataFrame:
    """Rows offset .. offset+size of the source order."""
    return PageIndex.build(raw).page(offset, size)


def extract(
    raw: DataFrame, cfg: LakeConfig, since, limit: int | None = None, until=None
) -> DataFrame:
    """Window, then the oldest `limit` rows; no limit means the whole window, unsorted."""
    cfg.check_limit(limit)
    rows = in_window(raw.select(*RAW_COLUMNS), since, until)
    return rows if limit is None else first_n(rows, limit)


def newest_created() -> Column:
    """Aggregate: the newest readable creation time of raw rows."""
    return F.max(created_at())


def effective_since(watermark: Column, since: Column, lookback_days: Column) -> Column:
    """Where an extract starts: the watermark minus the lookback, never before `since`."""
    back = F.make_dt_interval(lookback_days, F.lit(0), F.lit(0), F.lit(0).cast("decimal(18,6)"))
    return F.greatest(since, watermark - back)


def advance(watermark: Column, seen: Column) -> Column:
    """The later of the two; a missing side is ignored, so a watermark never moves back."""
    return F.greatest(watermark, seen)
