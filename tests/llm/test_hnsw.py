from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

from ticketlake.llm import hnsw

SCHEMA = "vec_id bigint, embedding array<double>, rank string, score string, digest string, shard string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], SCHEMA).repartition(3)


def answers(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(rows) for q, rows in out.items()}


def good(v):
    return bool(v) and None not in v and np.isfinite(v).all() and any(v)


def brute(rows, ask, k):
    """Every query against every other row, for tables whose queries have ids of their own."""
    dim = max((len(v) for _, v in rows if v), default=0)
    pad = lambda v: np.array([*v, *[0.0] * (dim - len(v))])
    fine = [(i, pad(v)) for i, v in rows if good(v)]
    out = {}
    for at, (q, vec) in enumerate(fine):
        if ask(q):
            near = sorted((-float((vec * v).sum()), i is None, i or 0) for j, (i, v) in enumerate(fine) if j != at)[:k]
            out[q] = [(n + 1, None if last else i, -s) for n, (s, last, i) in enumerate(near)]
    return out


def close(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [r[:2] for r in got[q]] == [r[:2] for r in want[q]], q
        assert np.allclose([r[2] for r in got[q]], [r[2] for r in want[q]], rtol=1e-12)


def test_small_odd_tables_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * rng.choice([0.2, 1, 9])).tolist()) for i in range(70)]
    rows += [(100 + i, rows[i % 3][1]) for i in range(40)]  # equal vectors, more than are asked for
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None]), (204, [float("nan")]), (205, [float("inf")])]
    rows += [(None, rows[5][1]), (None, [3.0, -1.0]), (-20, [2.0, 0.0, 1.0]), (206, [-0.0, 1.0]), (207, [1e200, 1.0])]
    ask = lambda q: q is not None and q % 20 == 0
    df = table(spark, rows)
    close(answers(hnsw.nearest(df, df.where("vec_id % 20 = 0"), k=15)), brute(rows, ask, 15))
    few = [(0, [1.0]), (20, [2.0]), (3, [1.0])]
    close(answers(hnsw.nearest(table(spark, few), k=9)), brute(few, lambda q: True, 9))


def test_rows_repeated_in_full_leave_out_one_of_themselves(spark):
    df = table(spark, [(40, [1.0, 0.0])] * 3 + [(7, [0.0, 1.0])])
    got = Counter(tuple(r) for r in hnsw.nearest(df, df.where("vec_id = 40"), k=3).collect())
    assert got == Counter({(40, 1, 40, 1.0): 3, (40, 2, 40, 1.0): 3, (40, 3, 7, 0.0): 3})


def test_no_rows_and_no_queries_give_no_rows(spark):
    empty, some = table(spark, []), table(spark, [(1, [1.0])])
    assert hnsw.nearest(empty).count() == 0
    assert hnsw.nearest(some, some.where("vec_id = 5")).count() == 0
    assert hnsw.nearest(some).count() == 0  # no other row
    assert hnsw.nearest(empty).columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("norms", [(1, 1), (0.3, 3)])
def test_recall_over_many_shards_and_one_very_common_vector(spark, norms):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 24)) * 0.4
    x *= (rng.uniform(*norms, size=4000) / np.linalg.norm(x, axis=1))[:, None]
    x[rng.permutation(4000)[:1300]] = x[0]
    df = table(spark, [(i, v) for i, v in enumerate(x.tolist())])
    got = answers(hnsw.nearest(df, df.where("vec_id % 20 = 0"), shard_rows=600))
    hits = total = 0
    for q in range(0, 4000, 20):
        scores = (x * x[q]).sum(1)
        order = [i for i in np.lexsort((np.arange(4000), -scores)).tolist() if i != q][:20]
        assert [r[0] for r in got[q]] == list(range(1, 21))
        assert np.allclose([r[2] for r in got[q]], scores[[r[1] for r in got[q]]], rtol=1e-12)
        assert got[q] == sorted(got[q], key=lambda r: (-r[2], r[1])) and q not in {r[1] for r in got[q]}
        hits, total = hits + len({r[1] for r in got[q]} & set(order)), total + 20
    assert hits / total >= 0.95
