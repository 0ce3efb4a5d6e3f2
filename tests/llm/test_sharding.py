from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from ticketlake.llm import sharding

BIG = 2**63 - 1


def check(table, rows, n):
    """Against one sort and one running sum."""
    data = [(BIG if i is None else i, (t or "").encode()) for i, t in rows]
    data.sort(key=lambda x: (hashlib.md5(x[1]).digest(), x[0]))
    total, before, slots, want = sum(len(b) + 8 for _, b in data), 0, [0] * n, []
    for i, b in data:
        shard = before * n // total
        want.append((i, len(b) + 8, zlib.crc32(b), shard, slots[shard]))
        slots[shard] += 1
        before += len(b) + 8
    columns = ("size", "text_crc32", "shard", "slot")
    got = [(BIG if r["doc_id"] is None else r["doc_id"], *(r[c] for c in columns)) for r in table.collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("n", [1, 5, 24])
def test_shards_equal_brute_force_with_a_third_in_one_group(docs, n):
    rng = random.Random(n)
    rows = [(i, "copy " * 30 if i % 3 == 0 else "y" * rng.randrange(400)) for i in range(400)]
    check(sharding.shard(docs(rows), n), rows, n)


def test_overfull_ranges_are_subdivided(docs, monkeypatch):
    rows = [(i, "") for i in range(900)] + [(1000 + i, f"{i}" * 500) for i in range(40)]
    rounds = []
    real = sharding._subdivide
    monkeypatch.setattr(sharding, "_subdivide", lambda *a: rounds.append(1) or real(*a))
    check(sharding.shard(docs(rows), 3), rows, 3)
    assert rounds  # the empty texts have few bytes, yet many rows


def test_odd_rows_and_an_empty_table(docs, odd_rows, empty):
    check(sharding.shard(docs(odd_rows), 4), odd_rows, 4)
    assert sharding.shard(empty, 4).count() == 0
    assert sharding.shard(docs([(1, "a")], "number", "body"), 2, "number", "body").first()["slot"] == 0
