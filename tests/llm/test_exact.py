from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from tests.llm.conftest import CLASHING
from ticketlake.llm import exact


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def check(table, rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[lowered(text)].append(i)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    got = defaultdict(list)
    for r in table.collect():
        got[bytes(r["digest"]).hex()].append(r)
    assert {d: sorted(map(str, ids)) for d, ids in by_digest.items()} == {
        d: sorted(str(r["doc_id"]) for r in rs) for d, rs in got.items()
    }
    for digest, members in got.items():
        last = max((i for i in by_digest[digest] if i is not None), default=None)
        assert {r["keep_id"] for r in members} == {last}
        assert {r["group_size"] for r in members} == {len(members)}
        assert [r["doc_id"] for r in members if r["kept"]] == [last]  # one row, also of repeated ones


@pytest.mark.parametrize("support", [1e-3, 0.05, 0.9])
def test_groups_equal_brute_force_with_a_third_in_one_group(docs, support):
    rng = random.Random(1)
    rows = [(i, "Hot TEXT" if i % 3 == 0 else f"Text {rng.randrange(60)}") for i in range(300)]
    check(exact.duplicate_groups(docs(rows), support=support), rows)


def test_odd_rows_and_other_columns(docs, odd_rows):
    check(exact.duplicate_groups(docs(odd_rows)), odd_rows)
    kept = exact.drop_duplicates(docs(odd_rows))
    assert kept.columns == ["doc_id", "text", *CLASHING]
    assert kept.count() == len({lowered(t) for _, t in odd_rows})


def test_other_names_and_an_empty_table(docs, empty):
    assert exact.duplicate_groups(empty).count() == exact.drop_duplicates(empty).count() == 0
    renamed = docs([(1, "a"), (2, "A")], "number", "body")
    assert [(r["number"], r["body"]) for r in exact.drop_duplicates(renamed, "number", "body").collect()] == [(2, "A")]


def test_frequent_digests_leave_by_broadcast(docs):
    plan = exact.duplicate_groups(docs([(i, "same") for i in range(50)]))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
