from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import ticket
from ticketlake.config import RAW_COLUMNS, fresh_dir
from ticketlake.operators import page_index
from ticketlake.operators.page_index import PageIndex
from ticketlake.operators.positions import SOURCE_ORDER, with_positions


def in_order(rows):
    at = [RAW_COLUMNS.index(c) for c in (*SOURCE_ORDER, *(c for c in RAW_COLUMNS if c not in SOURCE_ORDER))]
    return sorted(rows, key=lambda r: ([(r[i] or "").encode() for i in at], [r[i] is None for i in at]))


def some_rows(rng, n):
    """Few creation times and keys, some missing, long and odd texts, copies."""
    days = [None, "", "2024-03-01T00:00:00.000", "2024-03-02T00:00:00.000", "x" * 90 + "a", "x" * 90 + "b", "ü", "🙂"]
    rows = [
        ticket(rng.choice([None, 1, 2, 30]), created_date=rng.choice(days), descriptor=rng.choice(["a", "b", None]), agency=str(rng.randrange(3)))
        for _ in range(n)
    ]
    return rows + rows[: n // 5] + rows[:1] * (n // 3)


@pytest.mark.parametrize(("n", "ranges", "at_once"), [(0, 8, 50), (1, 8, 50), (240, 40, 20), (240, 300, 5), (200, 2, 1000)])
def test_pages_make_up_the_source_order(raw, n, ranges, at_once):
    rows = some_rows(random.Random(n + ranges), n)
    df = raw(rows).repartition(3)
    index, want = PageIndex.build(df, ranges, at_once), in_order(rows)
    assert sum(r.rows for r in index.ranges) == len(rows)
    cuts = [(0, 7), (0, 1000), (len(rows) // 2, 60), (max(len(rows) - 3, 0), 10), (len(rows), 5), (3, 0)]
    for offset, size in cuts:
        got = [tuple(r) for r in index.page(offset, size).collect()]
        assert in_order(got) == want[offset : offset + size]


def test_a_saved_index_serves_further_pages(spark, raw):
    rows = some_rows(random.Random(9), 120)
    df, path = raw(rows), fresh_dir(spark, "pages")
    index = PageIndex.build(df, 16)
    index.save(path)
    again = PageIndex.load(spark, path, df)
    assert again.ranges == index.ranges
    assert in_order([tuple(r) for r in again.page(31, 40).collect()]) == in_order(rows)[31:71]


def test_a_page_reads_its_ranges_and_sorts_nothing_else(spark, raw, monkeypatch):
    path = fresh_dir(spark, "stored")
    raw([ticket(i, created_date=f"2024-03-{1 + i % 28:02d}T{i % 24:02d}:00:00.000") for i in range(2000)]).write.parquet(path)
    index = PageIndex.build(spark.read.parquet(path), 50)
    monkeypatch.setattr(page_index, "with_positions", None)
    page = index.page(1000, 30)
    plan = page._jdf.queryExecution().toString()
    assert "TakeOrdered" in plan and "GreaterThanOrEqual(created_date,2024-03-1" in plan and "Exchange rangepartitioning" not in plan
    inside = [r for r in index.ranges if r.low]
    assert len(inside) > 30 and max(r.rows for r in inside) < 200


def test_positions_follow_task_numbers_and_not_names(spark, raw):
    rows = spark.range(500).select((F.col("id") * 37 % 500).alias("v")).repartition(7)
    got = with_positions(rows, [F.col("v").desc()], "numbers").collect()
    assert sorted((r["position"], r["v"]) for r in got) == [(i, 499 - i) for i in range(500)]
    assert with_positions(rows.limit(0), [F.col("v")], "none").count() == 0
    numbers = spark.createDataFrame([("part-00009-a",), ("part-100000-a",), ("part-99999-b",)], "name string")
    order = numbers.orderBy(F.regexp_extract("name", r"part-(\d+)", 1).cast("long")).collect()
    assert [r[0][5:11].strip("-") for r in order] == ["00009", "99999", "100000"]
