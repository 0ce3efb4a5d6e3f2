from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.conftest import CLASHING, prose
from ticketlake.llm import suffix_dedup
from ticketlake.llm.suffix_sort import deep_shallow

BIG = 2**63 - 1


@pytest.mark.parametrize("length", [1, 7, 8, 24, 25, 60, 100])
def test_sorting_equals_sorted_strings(length):
    rng = random.Random(length)
    for _ in range(20):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(60))) for _ in range(3)] + [b"\x00", b"\xff", b"ab" * 40]
        data = b"".join(rng.choices(parts, k=rng.randrange(1, 12))) + b"z" * length
        starts = np.array(rng.sample(range(len(data) - length + 1), min(80, len(data) - length + 1)))
        order, classes = deep_shallow(data, starts, length)
        strings = [data[s : s + length] for s in starts]
        number = {s: i for i, s in enumerate(sorted(set(strings)))}
        assert [strings[i] for i in order] == sorted(strings)
        assert [number[s] for s in strings] == classes.tolist()


def brute_force(rows, length):
    seen, out = {}, []
    data = [(BIG if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for s in range(len(b) - length + 1):
            key = b[s : s + length]
            seen[key] = min(seen.get(key, (i, s)), (i, s))
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] < (i, s):
                gone[s : s + length] = b"\x01" * length
        runs = [k for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1])]
        out.append((i, len(b), sum(gone), len(runs), bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out)


def result(table, id_col="doc_id"):
    rows = []
    for r in table.collect():
        i = r["row"][id_col]
        rows.append((BIG if i is None else i, r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])))
    return sorted(rows)


def corpus(seed):
    rng = random.Random(seed)
    passage, page = prose(rng, 40), prose(rng, 120)
    rows = []
    for i in range(120):
        text = prose(rng, rng.randrange(40))
        if i % 3 == 0:  # a passage in a third of all texts, between words of their own
            text += " " + passage + " " + prose(rng, rng.randrange(12))
        if i % 7 == 0:
            words = page.split()
            words[rng.randrange(len(words))] = "changed"
            text += "\n" + " ".join(words)
        rows.append((i * 5 % 121, page if i % 10 == 9 else text))
    return rows + [(500, "ab" * 300), (501, "b" + "ab" * 150), (502, "aaaa" * 90)]


@pytest.mark.parametrize("hot", [1000, 3])
def test_removed_bytes_equal_brute_force(docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = corpus(hot)
    assert result(suffix_dedup.repeated_bytes(docs(rows))) == brute_force(rows, 100)


def test_pieces_of_long_texts_and_small_blocks(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 200)
    monkeypatch.setattr(suffix_dedup, "BLOCK_ROWS", 4)
    rows = corpus(8)[:60]
    for length in (30, 100):
        assert result(suffix_dedup.repeated_bytes(docs(rows), length=length)) == brute_force(rows, length)


def test_odd_rows(docs, odd_rows):
    rows = [(i, t if t is None else t[:20_000]) for i, t in odd_rows]
    assert result(suffix_dedup.repeated_bytes(docs(rows))) == brute_force(rows, 100)


def test_very_long_texts(docs, odd_rows):
    assert max(len(t or "") for _, t in odd_rows) > 100_000
    assert result(suffix_dedup.repeated_bytes(docs(odd_rows))) == brute_force(odd_rows, 100)


def test_blocks_are_bounded_in_rows_and_bytes(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_ROWS", 16)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    rng = random.Random(9)
    rows = [(i, None if i % 31 == 0 else "é" * rng.choice([0, 1, 100, 126, 240, 500, 1100, 4000])) for i in range(400)]
    table = suffix_dedup._with_blocks(docs(rows), "doc_id", "text")
    sizes = {}
    for r in table.select("block", "text").collect():
        sizes.setdefault(r["block"], []).append(len(r["text"].encode()))
    assert all(len(x) <= 16 and (sum(x) <= 4000 or len(x) == 1) for x in sizes.values())
    assert len(sizes) < 300  # short neighbours do share blocks
    rows = corpus(9)[:60]
    assert result(suffix_dedup.repeated_bytes(docs(rows))) == brute_force(rows, 100)


def test_counts_above_a_byte_are_whole():
    count = np.array([1, 254, 255, 256, 510, 511, 3])
    entries, parts = suffix_dedup._in_bytes(np.arange(7), count)
    assert np.bincount(entries, weights=parts).tolist() == count.tolist()
    assert parts.min() > 0 and parts.max() <= 255


def test_texts_stay_whole_characters_and_columns_stay(docs, empty):
    rows = [(1, "é" * 80), (2, "x" + "é" * 80 + "y"), (3, None)]
    cut = suffix_dedup.without_repeats(docs(rows))
    assert cut.columns == ["doc_id", "text", *CLASHING]
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    # in the first text every string after the start repeats; a character only partly covered stays
    assert texts == {1: "é", 2: "xy", 3: ""}
    assert suffix_dedup.without_repeats(empty).count() == suffix_dedup.repeated_bytes(empty).count() == 0
    renamed = docs(rows, "number", "body")
    assert suffix_dedup.without_repeats(renamed, "number", "body").columns == ["number", "body", *CLASHING]


@pytest.mark.parametrize("hot", [1000, 3])
def test_repeated_rows_and_ids_in_several_blocks(docs, monkeypatch, hot):
    """Rows repeated in full, and rows of the same id and start but other text, each lose their own bytes."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_ROWS", 4)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = corpus(7)[:60]
    rows += rows[:40] + [(i, t + " " + prose(random.Random(i), 12)) for i, t in rows[:40]]
    assert result(suffix_dedup.repeated_bytes(docs(rows))) == brute_force(rows, 100)
