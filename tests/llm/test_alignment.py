from __future__ import annotations

import base64
import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from ticketlake.llm import alignment
from ticketlake.llm.queries import op11_alignment

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.no_padding()
    a.no_truncation()
    a.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        of_id = {int(i): base64.b64decode(token) for token, i in map(bytes.split, file)}
    return a, of_id, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def pieces_bytes(pieces, i):
    name = pieces.id_to_piece(i)
    return bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()


def brute(texts, libraries):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), byte by byte."""
    a, of_id, pieces = libraries
    tokens = []
    for text in texts:
        found = [], []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
            names = [of_id[i] for i in ids[0]], [pieces_bytes(pieces, i) for i in ids[1]]
            if all(b"".join(n) == (" " + text).encode() for n in names):
                found = [list(zip(i, n, strict=True)) for i, n in zip(ids, names, strict=True)]
        tokens.append(found)
    rows, docs = [], Counter()
    for found in tokens:
        owner = [[at for at, (_, n) in enumerate(side) for _ in n] for side in found]
        links = {(x, y) for x, y in zip(*owner, strict=True)}
        linked = [(found[0][x][0], found[1][y][0]) for x, y in links]
        ends = [set(np.cumsum([len(n) for _, n in side]).tolist()) for side in found]
        groups, sides = sorted(ends[0] & ends[1]), []
        for side in found:
            of, at = defaultdict(list), 0
            for i, n in side:
                at += len(n)
                of[next(g for g in groups if g >= at)].append(str(i))
            sides.append(of)
        text = ";".join(",".join(sides[0][g]) + "|" + ",".join(sides[1][g]) for g in groups)
        rows.append((len(found[0]), len(found[1]), len(groups), linked, sha256(text.encode()).hexdigest() if text else ""))
        docs.update(set(linked))
    top = defaultdict(int)
    for (x, _), n in docs.items():
        top[x] = max(top[x], n)
    return [
        (n_a, n_b, n_g, len(linked), sum(docs[p] == top[p[0]] for p in linked), sum(docs[p] for p in linked), digest)
        for n_a, n_b, n_g, linked, digest in rows
    ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def aligned(spark, df, **more):
    rows = alignment.align(df, alignment.vocabularies(spark, A_PATH, B_PATH), **more).collect()
    return sorted(tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in rows)


def test_odd_texts_equal_the_libraries(spark, docs, libraries):
    rng = random.Random(1)
    texts = [
        None, "", " ", "   ", "\n", "a", " a", "a ", "a  b\n  c \t d", "x\n y\n\n   z", "<|endoftext|><s></s><unk> <0x41>",
        "a▁b", "▁", "日本語のテキスト", "🙂🙂 ﬁ é", "é", "\x00\x01", " x　y", "'s 'll don't", "1234567 89",
        "aa" * 3000, prose(rng, 400), prose(rng, 400).upper(), "\r\n\r\n", "zzz" + " " * 40 + "q", "﻿x", "   ",
    ]
    texts += [prose(rng, rng.randrange(1, 60)) for _ in range(60)] + [prose(random.Random(9), 30)] * 20
    df = docs(list(enumerate(texts)))
    want = [(i, *row) for i, row in enumerate(brute(texts, libraries))]
    for held in (alignment.HELD, 40, 0):  # pairs that tasks hold; the others are looked up
        assert aligned(spark, df, held=held) == want


def test_repeated_rows_are_documents_of_their_own_and_empty_tables_have_none(spark, docs, libraries):
    texts = ["Same text here.", "Same text here.", "other text"]
    df = docs([(4, texts[0]), (4, texts[1]), (None, texts[2])])
    got = sorted((alignment.align(df, alignment.vocabularies(spark, A_PATH, B_PATH))).collect(), key=lambda r: r["doc_id"] or 0)
    want = brute(texts, libraries)
    assert [tuple(r[c] for c in COLUMNS) for r in got] == [want[2], want[0], want[1]]
    assert aligned(spark, docs([])) == []


def test_products_of_sparse_matrices_equal_dense_ones(monkeypatch):
    rng = np.random.default_rng(2)
    for expanded in (1, 7, 1 << 20):
        monkeypatch.setattr(alignment, "EXPANDED", expanded)
        for _ in range(20):
            shape = rng.integers(0, 9, 3)
            x, y = (rng.integers(0, 3, s) * rng.integers(0, 2, s) for s in (shape[:2], shape[1:]))
            sparse = []
            for m in (x, y):
                row, column = np.nonzero(m)
                start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(m)))]).astype(np.int64)
                sparse.append(alignment.Rows(start, column.astype(np.int32), m[row, column], m.shape[1]))
            product = sparse[0].times(sparse[1])
            dense = np.zeros((shape[0], shape[2]), int)
            rows = np.repeat(np.arange(len(product)), np.diff(product.start))
            dense[rows, product.column] = product.value
            assert len(product) == shape[0] and (dense == x @ y).all() and len(product.column) == (x @ y > 0).sum()


def test_shared_group_links_pair_all_tokens_of_a_group():
    found = alignment.Alignment.of(np.array([2, 3, 6, 9]), np.array([1, 3, 9]))
    links = found.shared_group_links()
    pairs = {(r, int(c)) for r in range(len(links)) for c in links.column[links.start[r] : links.start[r + 1]]}
    assert pairs == {(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (3, 2)}
    overlap = {(r, int(c)) for r in range(4) for c in found.links.column[found.links.start[r] : found.links.start[r + 1]]}
    assert overlap == {(0, 0), (0, 1), (1, 1), (2, 2), (3, 2)}


def test_the_query_equals_the_libraries(spark, libraries):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows], libraries), strict=True))
    got = op11_alignment(spark, sf_dir).collect()
    assert len(got) == len(rows) and {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want
