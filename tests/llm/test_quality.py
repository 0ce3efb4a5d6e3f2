from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest

from tests.llm.conftest import CLASHING, prose
from ticketlake.llm import quality


def junk(rng):
    words = prose(rng, rng.randrange(20, 80)).split()
    return rng.choice([" ".join(w + "$$$" for w in words), " ".join(w for w in words for _ in range(6))])


def corpus(seed, n):
    rng = random.Random(seed)
    return [(i, junk(rng) if i % 5 == 0 else prose(rng, rng.randrange(5, 200)), int(i % 5 != 0)) for i in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    rows = corpus(1, 300)
    texts = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (999, "")], "doc_id bigint, text string")
    labels = [(i, y) for i, _, y in rows] + [(None, 1), (3, None), (7, 5), (123_456, 0)]
    return quality.fit(texts, spark.createDataFrame(labels, "doc_id bigint, label int"))


def test_held_out_documents_are_told_apart(spark, model):
    rows = corpus(2, 200)
    table = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in quality.score(table, model).collect()}
    right = [(got[i] >= 0.3) == bool(y) for i, _, y in rows]
    assert np.mean(right) > 0.97


def test_scores_equal_all_cosines_by_brute_force(model):
    texts = [t.encode() for _, t, _ in corpus(3, 20)] + [b"", b"x"]
    for text, score in zip(texts, model.score(texts), strict=True):
        vec = model.terms([text])[0].astype(float) @ model.axes.astype(float)
        cosines = model.vectors @ (vec / max(np.linalg.norm(vec), 1e-12))
        near = np.flatnonzero(cosines >= np.sort(cosines)[-quality.NEIGHBOURS] - 1e-7)
        weight = np.maximum(cosines[near], 0) ** quality.SHARPNESS
        want = (weight * model.labels[near]).sum() / weight.sum() if weight.sum() else model.prior
        assert score == pytest.approx(want, abs=1e-2)


def test_the_model_is_bounded_and_learns_from_known_labels_only(spark, model, monkeypatch):
    assert len(model.labels) <= 300 and set(model.labels.tolist()) <= {0.0, 1.0}
    monkeypatch.setattr(quality, "MAX_LABELLED", 20)
    texts = spark.createDataFrame([(i, t) for i, t, _ in corpus(4, 60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus(4, 60)], "doc_id bigint, label int")
    assert len(quality.fit(texts, labels).labels) == 20


def test_odd_rows_empty_tables_and_no_labels(spark, docs, odd_rows, empty, model):
    scored = quality.score(docs(odd_rows), model)
    assert scored.columns == ["doc_id", "text", *(c for c in CLASHING if c != "score"), "score"]
    scores = [r["score"] for r in scored.collect()]
    assert len(scores) == len(odd_rows) and all(0 <= s <= 1 for s in scores)
    by_text = {}
    for r in scored.collect():
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert quality.score(empty, model).count() == 0
    none = quality.fit(empty, spark.createDataFrame([], "doc_id bigint, label int"))
    assert {r["score"] for r in quality.score(docs(odd_rows), none).collect()} == {0.5}


def test_axes_and_weights_equal_a_plain_decomposition(spark):
    rows = corpus(5, 90)
    texts = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string").repartition(3)
    fitted = quality.fit(texts, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, label int"))
    counts = quality.term_counts([t.encode() for _, t, _ in rows])
    assert np.allclose(fitted.weights, np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))) + 1, rtol=1e-5)
    terms = fitted.terms([t.encode() for _, t, _ in rows]).astype(float)
    values, axes = np.linalg.eigh(terms.T @ terms)
    # the same space: what the axes keep of every text is what the largest eigenvectors keep
    best = axes[:, ::-1][:, : quality.DIMENSIONS]
    kept, want = (np.linalg.norm(terms @ a, axis=1) for a in (fitted.axes.astype(float), best))
    assert np.allclose(kept, want, rtol=2e-2) and kept.sum() == pytest.approx(want.sum(), rel=2e-3)


def test_word_pairs_are_counted_by_class():
    words = [w.encode() for w in "to be or not to be".split()]
    got = quality.term_counts([b" to be or\nnot  to be "])[0, quality.BYTE_TERMS :]
    want, n = np.zeros(len(got)), quality.WORD_CLASSES
    for nth, back in enumerate(quality.PLACES):
        for a, b in zip(words, words[back:]):
            want[nth * n * n + crc32(a) % n * n + crc32(b) % n] += 1
    assert (got == want).all() and quality.term_counts([b"", b"one"])[:, quality.BYTE_TERMS :].sum() == 0


def test_a_text_scores_the_same_in_any_block(model):
    texts = [t.encode() for _, t, _ in corpus(6, 150)]
    alone = [model.score([t])[0] for t in texts[:40]]
    assert (model.score(texts[:40]) == alone).all() and (model.score(texts[:128][::-1])[::-1][:40] == alone).all()
