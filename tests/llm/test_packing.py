from __future__ import annotations

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketlake.llm import packing


def padding(limits, lengths, counts):
    return sum(n * (min(x for x in limits if x >= length) - length) for length, n in zip(lengths, counts, strict=True))


@pytest.mark.parametrize("seed", range(40))
def test_boundaries_equal_all_choices(seed):
    rng = random.Random(seed)
    lengths = np.array(sorted(rng.sample(range(60), rng.randrange(1, 9))), float)
    counts, k = np.array([rng.randrange(1, 9) for _ in lengths], float), rng.randrange(1, 5)
    found = packing.boundaries(lengths, counts, k)
    choices = (
        (*part, lengths[-1]) for r in range(min(k, len(lengths))) for part in itertools.combinations(lengths[:-1], r)
    )
    assert found == sorted(set(found)) and len(found) <= k
    assert padding(found, lengths, counts) == min(padding(c, lengths, counts) for c in choices)


def check(table, sizes, context, budget, buckets):
    rows = table.collect()
    want = sorted(
        (str(i), p, p * context, min(context, n - p * context)) for i, n in sizes for p in range(max(1, -(-n // context)))
    )
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["n_tokens"]) for r in rows) == want
    limits = sorted({r["bucket"] for r in rows})
    assert len(limits) <= buckets
    batches = defaultdict(lambda: defaultdict(list))
    for r in rows:
        assert r["bucket"] == min(x for x in limits if x >= r["n_tokens"])
        assert r["padding"] == r["bucket"] - r["n_tokens"]
        batches[r["bucket"]][r["batch"]].append(r["slot"])
    for limit, by_batch in batches.items():
        fit = budget // max(limit, 1)
        assert sorted(by_batch) == list(range(len(by_batch)))
        for batch, slots in by_batch.items():
            assert sorted(slots) == list(range(len(slots)))
            assert len(slots) == fit or (batch == len(by_batch) - 1 and len(slots) < fit)


@pytest.mark.parametrize(("context", "budget", "buckets"), [(50, 200, 4), (8192, 1 << 18, 16), (1, 1, 1)])
def test_packs_hold_every_token_once(docs, context, budget, buckets):
    rng = random.Random(context)
    rows = [(i, "z" * (40 if i % 3 == 0 else rng.randrange(160))) for i in range(250)]
    packed = packing.pack(docs(rows), context=context, batch_tokens=budget, buckets=buckets)
    check(packed, [(i, len(t)) for i, t in rows], context, budget, buckets)


def test_odd_rows_own_lengths_and_an_empty_table(docs, odd_rows, empty):
    sizes = [(i, len((t or "").encode())) for i, t in odd_rows]
    check(packing.pack(docs(odd_rows), context=1000, batch_tokens=5000, buckets=6), sizes, 1000, 5000, 6)
    assert packing.pack(empty).count() == 0
    words = F.size(F.split("text", " ")).cast("long")
    packed = packing.pack(docs([(1, "a b c"), (2, "a")]), tokens=words)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in packed.collect()) == [(1, 3), (2, 1)]
    with pytest.raises(ValueError):
        packing.pack(empty, context=10, batch_tokens=9)
