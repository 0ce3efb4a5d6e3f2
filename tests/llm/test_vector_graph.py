from __future__ import annotations

import random

import numpy as np
import pytest

from ticketlake.llm import vector_graph
from ticketlake.llm.components import local_roots

BIG = 2**63 - 1


def clustered(seed, n, dim=16):
    """Vectors around few centres, a third of them around one."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    at = np.where(np.arange(n) % 3 == 0, 0, rng.integers(0, 12, n))
    noise = rng.choice([0.02, 0.1, 0.3], n)[:, None]
    return centres[at] + noise * rng.normal(size=(n, dim))


def brute_force(rows, threshold=0.95):
    ids = np.array([BIG if i is None else i for i, _ in rows])
    dim = max((len(v) for _, v in rows if v), default=1)
    x = np.zeros((len(rows), dim))
    for k, (_, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and any(v):
            x[k, : len(v)] = np.array(v) / max(map(abs, v))
    size = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / np.where(size > 0, size, 1)
    links = x @ x.T >= threshold
    np.fill_diagonal(links, False)
    a, b = np.nonzero(links | np.eye(len(rows), dtype=bool))
    _, roots = local_roots(a, b)
    lowest = {r: int(ids[roots == r].min()) for r in set(roots.tolist())}
    return sorted((int(i), int(n), lowest[r]) for i, n, r in zip(ids, links.sum(1), roots.tolist(), strict=True))


def result(table):
    big = lambda x: BIG if x is None else x
    return sorted((big(r["vec_id"]), r["n_links"], big(r["component_id"])) for r in table.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, node string")


@pytest.mark.parametrize(("cluster", "part"), [(256, 1024), (40, 64)])
def test_links_found_by_the_graph(spark, monkeypatch, cluster, part):
    """With small clusters and parts the hot cluster meets in pairs of parts."""
    monkeypatch.setattr(vector_graph, "CLUSTER", cluster)
    monkeypatch.setattr(vector_graph, "PART", part)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(1, 500))]
    got, want = result(vector_graph.linked_vectors(table(spark, rows))), brute_force(rows)
    found, true = sum(n for _, n, _ in got), sum(n for _, n, _ in want)
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))  # none below the threshold
    assert found >= 0.98 * true
    assert np.mean([a[2] == b[2] for a, b in zip(got, want, strict=True)]) > 0.98


def test_neighbour_lists_are_pruned_and_searched_beyond_them():
    x = clustered(2, 300).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = vector_graph.robust_neighbours(x)
    assert lists.shape[1] == vector_graph.DEGREE
    assert all(i not in row and len(set(row[row >= 0])) == (row >= 0).sum() for i, row in enumerate(lists))
    near = [np.unique(np.concatenate([r[r >= 0], np.nonzero((lists == i).any(1))[0]])) for i, r in enumerate(lists)]
    met = vector_graph.Search(x, near, 0.85).run()
    close = x @ x.T >= 0.95
    assert (met[close] > -1.5).mean() > 0.98  # far more than the lists hold
    assert np.allclose(met[met > -1.5], (x @ x.T)[met > -1.5], atol=1e-5)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0, 0.0]),
        (8, [2.0]), (9, [1e300, 1e299]), (10, [1e-300, 1e-301]), (10, [1.0, 0.1]), (None, [-1.0, 0.0]), (None, [-1.0, 0.01]),
        (11, [0.0, 0.0, -5.0]),
    ]
    assert result(vector_graph.linked_vectors(table(spark, rows))) == brute_force(rows)
    assert vector_graph.linked_vectors(table(spark, [])).count() == 0
    assert result(vector_graph.linked_vectors(table(spark, [(1, None)]))) == [(1, 0, 1)]


def test_copies_are_one_node_and_count_as_links(spark):
    rng = random.Random(3)
    rows = [(i, [float(i % 3), 1.0, rng.choice([0.0, 0.01])]) for i in range(90)]
    assert result(vector_graph.linked_vectors(table(spark, rows))) == brute_force(rows)


def test_the_audit_asks_for_more_overlap(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "CLUSTER", 8)
    monkeypatch.setattr(vector_graph, "OVERLAP", 1)
    asked, real = [], vector_graph._searched
    monkeypatch.setattr(vector_graph, "_searched", lambda *a: asked.append(a[2]) or real(*a))
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(4, 200))]
    found = sum(n for _, n, _ in result(vector_graph.linked_vectors(table(spark, rows))))
    assert asked[0] == 1 and asked[-1] > 1
    assert found >= 0.95 * sum(n for _, n, _ in brute_force(rows))


def scattered_pairs(seed, n, dim=64):
    """Evenly spread vectors; every second one lies close to the one before it."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1::2] = x[::2] + rng.normal(size=x[::2].shape) * 0.28 / np.sqrt(dim)
    return x


def test_links_of_vectors_outside_the_sample_are_audited(spark, monkeypatch):
    """Each sampled vector has a centroid of its own; the others meet in too few clusters."""
    monkeypatch.setattr(vector_graph, "CLUSTER", 8)
    monkeypatch.setattr(vector_graph, "SAMPLE_PER_CLUSTER", 1)
    monkeypatch.setattr(vector_graph, "AUDITED", 32)
    rows = [(i, v.tolist()) for i, v in enumerate(scattered_pairs(5, 600))]
    found = sum(n for _, n, _ in result(vector_graph.linked_vectors(table(spark, rows))))
    assert found >= 0.98 * sum(n for _, n, _ in brute_force(rows))


def test_all_vectors_are_compared_where_the_search_finds_too_little(spark, monkeypatch):
    """Also in several chunks: neither the search nor the number of chunks changes the result."""
    nothing = lambda nodes, *a: nodes.select("node", nodes.node.alias("links"), nodes.node.alias("root")).limit(0)
    monkeypatch.setattr(vector_graph, "_searched", nothing)
    monkeypatch.setattr(vector_graph, "CHUNK", 70)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(6, 200))] + [(900, clustered(6, 200)[7].tolist())]
    assert result(vector_graph.linked_vectors(table(spark, rows))) == brute_force(rows)


def test_the_audit_draws_a_bounded_number_where_nothing_is_linked(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "AUDITED", 16)
    monkeypatch.setattr(vector_graph, "DRAWN", 100)
    drawn, real = [], vector_graph._chunks
    chunks = lambda *a: (drawn.append(len(c[0])) or c for c in real(*a))
    monkeypatch.setattr(vector_graph, "_chunks", chunks)
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(7).normal(size=(300, 32)))]
    monkeypatch.setattr(vector_graph, "SAMPLE_PER_CLUSTER", 1)
    assert result(vector_graph.linked_vectors(table(spark, rows))) == brute_force(rows)
    assert drawn == [16, 32, 52]


def test_a_sample_of_few_bytes_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "CLUSTER", 40)
    monkeypatch.setattr(vector_graph, "SAMPLE_BYTES", 5 * 16 * 8)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(8, 200))]
    found = sum(n for _, n, _ in result(vector_graph.linked_vectors(table(spark, rows))))
    assert found >= 0.98 * sum(n for _, n, _ in brute_force(rows))
