from __future__ import annotations

import random
from binascii import crc32
from collections import defaultdict
from hashlib import sha256

import pytest

from ticketlake.llm import conversations, edit_lattice
from ticketlake.llm.queries import op12_repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, place string, gone string, audit string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(4)


def plain_search(rows, start=0, ends=(0, 3)):
    """Row by row: the least (cost, audit) of each state, by the letters' rules alone."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def moves(state, row):
        fault, initial = row
        yield state, 3, "D"
        if fault not in ("blank", "duplicate"):
            cut = fault == "truncated"
            if (state, initial) in step:
                yield step[state, initial], cut, "K"
            for role in "ua":
                if (state, role) in step:
                    yield step[state, role], 2 + cut, "R"

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                for role in "ua":
                    if (state, role) in step:
                        to, way = step[state, role], (cost + 2, audit + "I")
                        best[to] = min(best.get(to, way), way)
        return best

    best = inserted({start: (0, "")})
    for row in rows:
        after = {}
        for state, (cost, audit) in best.items():
            for to, more, letter in moves(state, row):
                way = cost + more, audit + letter
                after[to] = min(after.get(to, way), way)
        best = inserted(after)
    return min((best[q] for q in ends if q in best), default=None)


def brute(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        by_conv[conv] += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = {}
    for conv, kept in by_conv.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in kept:
            bare = text.rstrip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = plain_search([(f, r[1][:1]) for f, r in zip(faults, kept, strict=True)])
        written, queue = [], list(kept)
        for letter in audit:
            row = None if letter == "I" else queue.pop(0)
            if letter == "K":
                written.append((row[1], row[2]))
            elif letter in "RI":
                last = written[-1][0][:1] if written else "s"
                written.append(("assistant" if last == "u" else "user", row[2] if row else ""))
        turns = {t for t, _, _ in kept if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            sha256("\n".join(f"{r}:{t}" for r, t in written).encode()).hexdigest(),
        )
    return out


def repaired(df):
    got = conversations.repair(conversations.damaged(df)).collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in got}
    assert len(out) == len(got)
    return out


TEXTS = ("Yes.", "No", "Why? ", "", " \n", "and then", "Fine!\t", "x", "日本。", "Yes.", None)


def talk(rng, conv, n, turns=None):
    roles = ("user", "assistant", "user", "assistant", "system", "tool", "", "User", None)
    return [(conv, i if turns is None else rng.choice(turns), rng.choice(roles), rng.choice(TEXTS) if rng.random() < 0.7 else f"t {rng.random()}.") for i in range(n)]


def test_random_conversations_equal_a_plain_search(spark):
    rng = random.Random(2)
    rows = [r for c in range(150) for r in talk(rng, c, rng.randrange(1, 9))]
    rows += [r for c in range(200, 230) for r in talk(rng, c, rng.randrange(1, 9), (None, 3, 3, 5, 9, -2))]
    rows += talk(rng, None, 6) + [(400, None, None, None)] * 3 + [(401, 5, "user", "Hm. " * 80_000)] + rows[:7]
    assert repaired(table(spark, rows)) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_one_very_long_conversation_spreads_over_segments(spark, seed):
    rng = random.Random(seed)
    long = talk(rng, 7, 1500)
    if seed == 1:  # one message again and again, and turns that go on behind every cut
        long = [(7, i // 100, "user", "Hello.") for i in range(1500)]
    if seed == 2:  # nothing to keep
        long = [(7, i, "user", " ") for i in range(900)]
    rows = long + talk(rng, 6, 4) + talk(rng, 8, 4)
    df = table(spark, rows)
    assert repaired(df) == brute(rows)
    want, got = brute(rows), defaultdict(list)
    for r in sorted(conversations.repaired_messages(conversations.damaged(df)).collect(), key=lambda r: r[1:3]):
        got[r["conv"]].append(f"{r['role']}:{r['text']}")
    assert all(sha256("\n".join(got[c]).encode()).hexdigest() == want[c][-1] for c in want)


def test_a_conversation_that_loses_all_rows_and_an_empty_table(spark):
    gone = [(c, t, "user", "Hi.") for c in range(200) for t in (0,) if crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    assert set(repaired(table(spark, gone)).values()) == {(0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}
    assert repaired(table(spark, [])) == {}


def test_both_searches_meet_at_the_least_edits():
    rng, letters = random.Random(4), "dsuaoSUAO"
    for _ in range(3000):
        rows = "".join(rng.choice(letters) for _ in range(rng.randrange(9)))
        plain = [("blank" if x == "d" else "truncated" if x.isupper() else "", x.lower()) for x in rows]
        start, ends = rng.randrange(4), rng.choice([(0, 3), (0,), (1,), (2,), (3,)])
        assert edit_lattice.cheapest(rows, start, ends) == plain_search(plain, start, ends), (rows, start, ends)


def test_the_query_equals_the_plain_search(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in op12_repair(spark, sf_dir).collect()}
    assert got == brute(rows)
