"""Pages of raw rows in the source order, through a small index of ranges: only ranges that hold a page are sorted."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.config import RAW_COLUMNS
from ticketlake.operators.positions import SOURCE_ORDER, source_order, with_positions

# Ranges of an index, sampled rows a range, characters of a column that a splitter keeps, and rows that are
# sorted at once; a range with more rows gets an index of its own.
RANGES, SAMPLED, PREFIX, SORTED = 256, 32, 64, 1_000_000
# Splitters that one step of a look-up compares.
_STEP = 16
_REST = tuple(c for c in RAW_COLUMNS if c not in SOURCE_ORDER)
_SCHEMA = T.StructType([T.StructField("low", T.ArrayType(T.StringType())), T.StructField("rows", T.LongType())])

Key = tuple[str, ...]


@dataclass(frozen=True)
class Range:
    """Rows whose key is at least `low` and below the next range's."""

    low: Key
    rows: int


def _key(columns: Sequence[str]) -> Column:
    return F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def _literal(key: Key, columns: Sequence[str]) -> Column:
    return F.struct(*[F.lit(v).alias(c) for v, c in zip(key, columns, strict=True)])


def _splitters(rows: DataFrame, columns: Sequence[str], ranges: int) -> list[Key]:
    """Quantiles of a bounded sample. Any texts are valid bounds, so long values may be cut."""
    short = [F.substring(F.coalesce(F.col(c), F.lit("")), 1, PREFIX).alias(c) for c in columns]
    sample = sorted(tuple(r) for r in rows.select(*short).orderBy(F.rand(7)).limit(ranges * SAMPLED).collect())
    return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []


def _range_of(splitters: list[Key], columns: Sequence[str]) -> Column:
    """How many splitters are at most the row's key, in two steps of comparisons."""
    if not splitters:
        return F.lit(0)
    key, bounds = _key(columns), [_literal(s, columns) for s in splitters]
    below = F.lit(0)
    if coarse := bounds[_STEP - 1 :: _STEP]:
        below = F.size(F.filter(F.array(*coarse), lambda s: s <= key)) * _STEP
    return below + F.size(F.filter(F.slice(F.array(*bounds), below + 1, _STEP), lambda s: s <= key))


def ranges_of(rows: DataFrame, columns: Sequence[str], ranges: int = RANGES) -> list[Range]:
    """Ranges of about equal size with their counts: a sample, then one aggregate over all rows."""
    splitters = _splitters(rows, columns, ranges)
    counts = dict(rows.groupBy(_range_of(splitters, columns).alias("range")).count().collect())
    lows = [("",) * len(columns), *splitters]
    return [Range(low, counts[i]) for i, low in enumerate(lows) if i in counts]


def _between(rows: DataFrame, columns: Sequence[str], low: Key, high: Key | None) -> DataFrame:
    """Rows from `low` to below `high`. The bounds on the first column alone reach the files."""
    key, first = _key(columns), F.col(columns[0])
    if any(low):
        rows = rows.filter((key >= _literal(low, columns)) & (first >= low[0] if low[0] else F.lit(True)))
    if high is not None:
        rows = rows.filter((key < _literal(high, columns)) & (first.isNull() | (first <= high[0])))
    return rows


class PageIndex:
    """Ranges of a table's rows in the source order. The same table gives the same pages whatever the index."""

    def __init__(self, rows: DataFrame, ranges: list[Range], columns: Sequence[str] = SOURCE_ORDER, sort_at_once: int = SORTED):
        self.rows, self.ranges, self.columns, self.sort_at_once = rows, ranges, tuple(columns), sort_at_once

    @classmethod
    def build(cls, raw: DataFrame, ranges: int = RANGES, sort_at_once: int = SORTED) -> PageIndex:
        rows = raw.select(*RAW_COLUMNS)
        return cls(rows, ranges_of(rows, SOURCE_ORDER, ranges), SOURCE_ORDER, sort_at_once)

    def save(self, path: str) -> None:
        """One small row a range, for whoever reads further pages of the same table."""
        table = self.rows.sparkSession.createDataFrame([(list(r.low), r.rows) for r in self.ranges], _SCHEMA)
        table.coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, raw: DataFrame) -> PageIndex:
        saved = sorted((tuple(r["low"]), r["rows"]) for r in spark.read.schema(_SCHEMA).parquet(path).collect())
        return cls(raw.select(*RAW_COLUMNS), [Range(*r) for r in saved])

    def page(self, offset: int, size: int) -> DataFrame:
        """Rows offset .. offset+size of the source order; fewer at the end of the table."""
        chosen, before = [], 0
        for i, r in enumerate(self.ranges):
            if before < offset + size and before + r.rows > offset:
                chosen.append((i, before))
            before += r.rows
        if not chosen or size <= 0:
            return self.rows.limit(0)
        first, last = chosen[0], chosen[-1]
        if sum(self.ranges[i].rows for i, _ in chosen) <= self.sort_at_once:
            part = self._part(first[0], last[0])
            return part.orderBy(*source_order()).offset(offset - first[1]).limit(size)
        out = None
        for i, start in chosen:
            at = max(offset - start, 0)
            rows = min(offset + size - start, self.ranges[i].rows) - at
            piece = self._within(i, at, rows)
            out = piece if out is None else out.unionByName(piece)
        return out

    def _part(self, first: int, last: int) -> DataFrame:
        high = self.ranges[last + 1].low if last + 1 < len(self.ranges) else None
        return _between(self.rows, self.columns, self.ranges[first].low, high)

    def _within(self, i: int, offset: int, size: int) -> DataFrame:
        """A page of one range. One too large to be sorted at once is divided further, by more columns where all its
        rows agree in these; rows that no column tells apart are numbered as they are stored."""
        part, total = self._part(i, i), self.ranges[i].rows
        if total <= self.sort_at_once:
            return part.orderBy(*source_order()).offset(offset).limit(size)
        for columns in (self.columns, (*SOURCE_ORDER, *_REST)):
            finer = ranges_of(part, columns, max(2, min(RANGES, 4 * -(-total // self.sort_at_once))))
            if len(finer) > 1:
                return PageIndex(part, finer, columns, self.sort_at_once).page(offset, size)
        numbered = with_positions(part, source_order(), "page")
        return numbered.filter(F.col("position").between(offset, offset + size - 1)).select(*RAW_COLUMNS)
