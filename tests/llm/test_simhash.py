from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import CLASHING, prose
from ticketlake.llm import simhash
from ticketlake.llm.components import components, local_roots
from ticketlake.llm.simhash import GrayIndex, fingerprint, gray_rank

BIG = 2**63 - 1


def slow_fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - 2**64 if value >> 63 else value


@pytest.mark.parametrize("n", [1, 3])
def test_fingerprints_equal_a_plain_count(n, odd_rows):
    for _, text in odd_rows:
        assert fingerprint((text or "").encode(), n) == slow_fingerprint(text, n)


def test_gray_ranks_order_neighbours_by_one_bit():
    codes = np.array(sorted(range(64), key=lambda x: int(gray_rank(np.array([x], np.uint64))[0])))
    assert all(bin(a ^ b).count("1") == 1 for a, b in zip(codes, codes[1:], strict=False))


@pytest.mark.parametrize("size", [1, 2, 15, 17, 130, 1500])
@pytest.mark.parametrize("distance", [0, 3])
def test_the_index_finds_every_neighbour(size, distance):
    rng = np.random.default_rng(size)
    centres = rng.integers(0, 2**63, 8, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (size, 4), dtype=np.uint64), axis=1)
    values = np.unique(centres[rng.integers(0, 8, size)] ^ flips)
    who, other = GrayIndex(values).near(values, distance)
    near = np.bitwise_count(values[:, None] ^ values) <= distance
    assert {*zip(who.tolist(), other.tolist(), strict=True)} == {*map(tuple, np.argwhere(near).tolist())}
    assert len(who) == near.sum()


def near_roots(rows, n, distance):
    """Per row its component, and the smallest id of each component."""
    bits = np.array([slow_fingerprint(t, n) for _, t in rows], np.int64).view(np.uint64)
    _, roots = local_roots(*np.nonzero(np.bitwise_count(bits[:, None] ^ bits) <= distance))
    roots = roots.tolist()
    return roots, {r: min(BIG if i is None else i for (i, _), k in zip(rows, roots, strict=True) if k == r) for r in roots}


def brute_force(rows, n, distance):
    roots, lowest = near_roots(rows, n, distance)
    prints = [slow_fingerprint(t, n) for _, t in rows]
    return sorted((BIG if i is None else i, p, lowest[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True))


def result(table):
    big = lambda x: BIG if x is None else x
    return sorted((big(r["doc_id"]), r["fingerprint"], big(r["component_id"])) for r in table.collect())


@pytest.mark.parametrize("group", [2000, 10])
def test_components_equal_brute_force_with_a_hot_group(docs, monkeypatch, group):
    """group: 10 deals the hot group again by finer tables."""
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = random.Random(3)
    base = prose(rng, 400).split()
    rows = []
    for i in range(90):
        words = list(base) if i % 3 else prose(rng, rng.randrange(60)).split()
        for _ in range(rng.randrange(3)):
            if words:
                words[rng.randrange(len(words))] = f"w{rng.randrange(99)}"
        rows.append((i, " ".join(words)))
    assert result(simhash.simhash_groups(docs(rows), 3, 3)) == brute_force(rows, 3, 3)


def test_odd_rows_and_the_filter(docs, odd_rows, empty):
    assert result(simhash.simhash_groups(docs(odd_rows), 3, 3)) == brute_force(odd_rows, 3, 3)
    kept = simhash.drop_near_duplicates(docs(odd_rows), 3, 3)
    assert kept.columns == ["doc_id", "text", *CLASHING]
    got = [(BIG if r["doc_id"] is None else r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(i for i, _ in got) == sorted(lowest for _, lowest in near_roots(odd_rows, 3, 3)[1].items())
    assert len(got) == len(set(got))
    assert simhash.simhash_groups(empty, 3, 3).count() == simhash.drop_near_duplicates(empty, 3, 3).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 400)] + [(399, 160), (5, 5)]
    got = dict(components(spark.createDataFrame(links, "u bigint, v bigint")).collect())
    assert set(got.values()) == {7} and got.keys() == {x for link in links[:-1] for x in link}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
