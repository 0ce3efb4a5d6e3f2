from __future__ import annotations

import random

import pytest

SYLLABLES = ("ka", "lo", "mi", "ren", "tu", "sol", "ve", "dan", "ö", "é")


def prose(rng: random.Random, n_words: int) -> str:
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(n_words)]
    return " ".join(w.title() if i % 9 == 0 else w for i, w in enumerate(words))


CLASHING = ("row", "digest", "block", "bucket", "size", "score", "shard", "component_id", "keep_id", "kept", "node", "hash")
"""Names that the operators use inside; the input may have them, too."""


@pytest.fixture
def docs(spark):
    """A table of (doc_id, text) rows with further columns of clashing names."""

    def make(rows, id_col="doc_id", text_col="text"):
        others = ", ".join(f"`{c}` string" for c in CLASHING)
        table = [(i, t, *("x" for _ in CLASHING)) for i, t in rows]
        return spark.createDataFrame(table, f"{id_col} bigint, {text_col} string, {others}").repartition(3)

    return make


@pytest.fixture
def odd_rows():
    """Null and empty texts, null ids, rows repeated in full, ids used twice, a very long text, odd characters."""
    rng = random.Random(5)
    shared = prose(rng, 60)
    long = prose(rng, 3000) + "\n" + shared + "\n" + "aa" * 4000 + "\n" + prose(rng, 20_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, shared), (5, shared), (5, shared), (None, shared), (None, None),
        (6, shared.upper()), (7, prose(rng, 50) + "\n" + shared), (7, "another text of the same id"),
        (8, long), (9, "🙂 中文 \x00 ﬁ\n\n" * 30), (10, "x"), (11, "...!!"), (12, long[:4000]), (-4, shared + " end"),
    ]


@pytest.fixture
def empty(docs):
    return docs([])
