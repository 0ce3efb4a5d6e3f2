from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import CLASHING
from ticketlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, TABLES = Tokenizer.from_file(PATH), bpe.Tables.load(PATH)
PIECES = [
    "a", "A", " ", "  ", "\n", "\t", "\x1c", "\x85", "᠎", "​", "　", "é", "ß", "中", "🙂", "1", "²", "'s", "'ll",
    "<|endoftext|>", "<|endo", ".", "!!", "\x00", "̀", "the", "aaaa", "ⅷ", " token", "izer",
]


def ids(packed):
    return [np.frombuffer(x, "<u4").tolist() for x in packed]


def library(texts):
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_encoding_equals_the_library_on_random_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(40))) for _ in range(1500)] + ["a" * 3000, " " * 200, "ab" * 999]
    encoder = bpe.Encoder(TABLES)
    assert ids(encoder.encode(texts[:700])) + ids(encoder.encode(texts[700:])) == library(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_encoding_equals_the_library_on_any_text(texts):
    texts = [x for x in texts if x.isprintable() or x.encode("utf-8", "ignore")]
    assert ids(bpe.Encoder(TABLES).encode(texts)) == library(texts)


def test_words_are_forgotten_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(bpe, "_HELD_WORDS", 3)
    encoder = bpe.Encoder(TABLES)
    for text in ("one two three four", "five six", "one seven"):
        assert ids(encoder.encode([text])) == library([text])
    assert len(encoder.known) <= 4


def test_the_round_trip_keeps_rows_and_other_columns(spark, docs, odd_rows, empty):
    shared = bpe.tables(spark, PATH)
    encoded = bpe.encode(docs(odd_rows), shared)
    assert encoded.columns == ["doc_id", *CLASHING, "ids"]
    back = bpe.decode(encoded, shared)
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == sorted((str(i), t or "") for i, t in odd_rows)
    assert bpe.decode(bpe.encode(empty, shared), shared).count() == 0


@pytest.mark.parametrize("numbers", [[], [50256, 13], [222, 10], [127], [99999, 13, 70000]])
def test_decoding_equals_the_library_on_any_ids(spark, numbers):
    table = spark.createDataFrame([(1, np.array(numbers, "<u4").tobytes())], "n int, ids binary")
    got = bpe.decode(table, bpe.tables(spark, PATH)).first()["text"]
    assert got == LIBRARY.decode([x for x in numbers if x < 50257], skip_special_tokens=False)
