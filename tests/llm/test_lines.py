from __future__ import annotations

import random

import numpy as np
import pytest

from ticketlake.llm import lines
from ticketlake.llm.perfect_hash import PerfectHash


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_every_pair_has_a_slot_of_its_own(n):
    rng = np.random.default_rng(n)
    key, half = rng.integers(-(2**63), 2**63, (2, n))
    key[: n // 2] = key[:1] if n else 0  # halves may agree
    index = PerfectHash.build(key, half)
    assert sorted(index.slots(key, half).tolist()) == list(range(n))
    assert index.words.nbytes * 8 <= 64 + 8 * n  # a few bits a key
    other = index.slots(*rng.integers(-(2**63), 2**63, (2, 500)))
    assert other.min() >= -1 and other.max() < max(n, 1)


def brute_force(rows, min_chars=10, min_docs=2):
    big = 2**63 - 1
    fold = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(fold(line), set()).add(big if i is None else i)
    out = []
    for i, text in rows:
        parts = (text or "").split("\n")
        kept = []
        for line in parts:
            who = holders[fold(line)]
            if len(fold(line)) < min_chars or len(who) < min_docs or min(who) == (big if i is None else i):
                kept.append(line)
        out.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(table):
    return sorted((tuple(r[c] for c in ("doc_id", "n_lines", "n_dropped", "text")) for r in table.collect()), key=str)


def test_lines_equal_brute_force_with_a_hot_line(docs):
    rng = random.Random(2)
    pool = [f"  Line number {i}\t" if i % 2 else f"line NUMBER {i}\r" for i in range(40)] + ["short", "", "same line everywhere"]
    rows = [(i, "\n".join(["Same Line everywhere " if i % 3 == 0 else "x"] + rng.choices(pool, k=rng.randrange(8)))) for i in range(200)]
    assert result(lines.drop_repeated_lines(docs(rows))) == brute_force(rows)


def test_odd_rows(docs, odd_rows):
    assert result(lines.drop_repeated_lines(docs(odd_rows))) == brute_force(odd_rows)


def test_parameters_and_an_empty_table(docs, empty):
    assert lines.drop_repeated_lines(empty).count() == 0
    rows = [(1, "ab\ncd"), (2, "AB\ncd"), (3, "cd")]
    table = docs(rows, "number", "body")
    got = lines.drop_repeated_lines(table, "number", "body", min_chars=2, min_docs=3)
    assert result(got) == brute_force(rows, 2, 3)
