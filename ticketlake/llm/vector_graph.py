"""Embedding near-dedup over a robust-pruned flat graph that is built on overlapping cluster shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import NO_ID, arrow_batches, stored
from ticketlake.llm.components import local_roots, lowest_labels

# Vectors a cluster has on average before overlap, clusters and sampled vectors at most, nearest clusters a
# vector joins, vectors of a part (larger clusters are cut into parts that meet in pairs).
CLUSTER, MAX_CLUSTERS, SAMPLE_PER_CLUSTER, OVERLAP, PART = 256, 16_384, 8, 2, 1024
# Neighbours kept, candidates looked at, how much nearer a kept neighbour must be to hide a candidate, and the
# beam of the greedy search.
DEGREE, CANDIDATES, ALPHA, BEAM = 24, 64, 1.2, 32
# The search goes on from vectors this far below the threshold; vectors that the audit draws at first and at most, and
# linked vectors that it wants; the recall that is asked for. Vectors and bytes of a block that is compared at once;
# bytes of the centroid sample.
SLACK, AUDITED, DRAWN, LINKED, RECALL = 0.1, 512, 8192, 256, 0.98
CHUNK, CHUNK_BYTES, SAMPLE_BYTES = 8192, 32 << 20, 128 << 20

_VECTORS = "vec_id long, vec binary"
_CELL = "node long, links long, root long"


def _normal(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column("embedding").to_pylist():
                vec = np.zeros(dim)
                if x and None not in x:
                    vec[: len(x)] = x
                top = np.abs(vec).max() if dim else 0.0
                if top > 0 and np.isfinite(top):
                    vec = vec / top  # neither large nor tiny components leave the range of doubles
                    out.append((vec / np.sqrt(vec @ vec) + 0.0).tobytes())
                else:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "vec"])

    return run


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows)).reshape(len(rows), -1)


def centroids(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means on a bounded sample."""
    chosen = sample[np.random.default_rng(0).choice(len(sample), k, replace=False)].astype(np.float32)
    sample = sample.astype(np.float32)
    for _ in range(rounds):
        near = np.concatenate([(sample[i : i + 4096] @ chosen.T).argmax(1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(chosen)
        np.add.at(sums, near, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        chosen = np.where(size > 0, sums / np.maximum(size, 1e-12), chosen)
    return chosen


def _assigned(shared, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        k = min(overlap, len(centres))
        for batch in batches:
            x = _matrix(batch.column("vec")).astype(np.float32)
            near = [np.argpartition(-(x[i : i + 1024] @ centres.T), k - 1, axis=1)[:, :k] for i in range(0, len(x), 1024)]
            lists = pa.array([sorted(r) for r in np.concatenate(near).tolist()] if near else [], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "clusters"])

    return run


def robust_neighbours(x: np.ndarray) -> np.ndarray:
    """Out-neighbours of each vector among the others, -1 where there are fewer.

    Candidates are the nearest vectors and some drawn at random, which give long edges. From the nearest on, a
    candidate is kept unless a kept neighbour is ALPHA times nearer to it than the vector itself.
    """
    n = len(x)
    random = np.random.default_rng(n).integers(0, n, (n, min(n, CANDIDATES // 4)))
    near = min(CANDIDATES, n)
    kept = np.full((n, DEGREE), -1)
    for at in range(0, n, 1024):
        rows = np.arange(at, min(at + 1024, n))
        cosine = x[rows] @ x.T
        candidate = np.concatenate([np.argpartition(-cosine, near - 1, axis=1)[:, :near], random[rows]], axis=1)
        far = 1 - np.take_along_axis(cosine, candidate, 1)
        order = np.argsort(far, axis=1, kind="stable")
        candidate, far = np.take_along_axis(candidate, order, 1), np.take_along_axis(far, order, 1)
        mine, count = np.full((len(rows), DEGREE), -1), np.zeros(len(rows), int)
        for step in range(candidate.shape[1]):
            new, away = candidate[:, step], far[:, step]
            between = 1 - np.einsum("nd,nrd->nr", x[new], x[mine])
            hidden = ((ALPHA * between <= away[:, None]) | (mine == new[:, None])) & (mine >= 0)
            ok = ~hidden.any(1) & (new != rows) & (count < DEGREE)
            mine[ok, count[ok]] = new[ok]
            count += ok
        kept[rows] = mine
    return kept


def _graph(table: pa.Table) -> pa.Table:
    """Adjacency of one shard, edges in both directions."""
    node, x = table.column("node").to_numpy(), _matrix(table.column("vec")).astype(np.float32)
    out = robust_neighbours(x)
    a, slot = np.nonzero(out >= 0)
    b = out[a, slot]
    edges = np.unique(np.concatenate([np.stack([a, b], 1), np.stack([b, a], 1)]), axis=0)
    lists = np.split(node[edges[:, 1]], np.searchsorted(edges[:, 0], np.arange(1, len(node)))) if len(node) else []
    return pa.table({"node": pa.array(node, pa.int64()), "near": pa.array([x.tolist() for x in lists], pa.list_(pa.int64()))})


class Search:
    """Greedy searches for all vectors of a cell at once, each from the medoid, then on through the range."""

    def __init__(self, x: np.ndarray, neighbours: list[np.ndarray], radius: float):
        self.x, self.radius = x, radius
        self.width = max([1, *map(len, neighbours)])
        self.near = np.full((len(x), self.width), -1)
        for i, row in enumerate(neighbours):
            self.near[i, : len(row)] = row
        self.cosine = np.full((len(x), len(x)), -2, np.float32)  # -2: not met
        self.open = np.zeros((len(x), len(x)), bool)

    def _meet(self, query: np.ndarray, other: np.ndarray) -> None:
        some = (other >= 0) & (self.cosine[query, other] < -1.5)
        query, other = query[some], other[some]
        for at in range(0, len(query), 1 << 15):
            q, o = query[at : at + (1 << 15)], other[at : at + (1 << 15)]
            self.cosine[q, o] = np.einsum("nd,nd->n", self.x[q], self.x[o])
            self.open[q, o] = True

    def _expand(self, query: np.ndarray, node: np.ndarray) -> None:
        self.open[query, node] = False
        for at in range(0, len(query), 1 << 14):
            q, n = query[at : at + (1 << 14)], node[at : at + (1 << 14)]
            self._meet(np.repeat(q, self.width), self.near[n].ravel())

    def run(self) -> np.ndarray:
        """Cosines of the pairs met; -2 elsewhere."""
        n = len(self.x)
        everyone = np.arange(n)
        medoid = int((self.x @ self.x.sum(0)).argmax())
        self._meet(everyone, np.full(n, medoid))
        while True:  # the best open vector of each beam
            beam = np.partition(self.cosine, n - min(BEAM, n), axis=1)[:, n - min(BEAM, n)]
            reach = np.where(self.open, self.cosine, -2)
            best = reach.argmax(1)
            go = np.flatnonzero((reach[everyone, best] >= beam) & (reach[everyone, best] > -1.5))
            if not len(go):
                break
            self._expand(go, best[go])
        while True:  # every open vector within the range
            query, node = np.nonzero(self.open & (self.cosine >= self.radius))
            if not len(query):
                return self.cosine
            self._expand(query, node)


def _linked(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        """A cell: one part of a cluster, or two parts whose vectors are linked across."""
        node, part = (table.column(c).to_numpy() for c in ("node", "part"))
        cluster, copies = table.column("cluster")[0].as_py(), table.column("copies").to_numpy()
        crossing = table.column("left")[0].as_py() != table.column("right")[0].as_py()
        exact = _matrix(table.column("vec"))
        place = {v: i for i, v in enumerate(node.tolist())}
        near = [np.array([place[v] for v in row or () if v in place], int) for row in table.column("near").to_pylist()]
        met = Search(exact.astype(np.float32), near, threshold - SLACK).run()
        a, b = np.nonzero(np.maximum(met, met.T) >= threshold - 1e-3)
        owned = _first_shared(table.column("clusters").to_pylist(), a, b) == cluster
        owned &= (a != b) & ((part[a] != part[b]) == crossing)
        a, b = a[owned], b[owned]
        true = np.concatenate(
            [np.zeros(0, bool)]
            + [np.einsum("nd,nd->n", exact[a[i : i + 8192]], exact[b[i : i + 8192]]) >= threshold for i in range(0, len(a), 8192)]
        )
        a, b = a[true], b[true]
        links = np.bincount(a, weights=copies[b], minlength=len(node)).astype(np.int64)
        root = node.copy()
        members, roots = local_roots(node[a], node[b])
        root[[place[v] for v in members.tolist()]] = roots
        some = links > 0
        return pa.table({"node": node[some], "links": links[some], "root": root[some]})

    return run


def _first_shared(clusters: list[list[int]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest cluster that both vectors are in: the only one that counts the pair."""
    of = np.array(clusters)
    out = np.full(len(a), np.iinfo(np.int64).max)
    for i in range(of.shape[1]):
        for j in range(of.shape[1]):
            same = of[a, i] == of[b, j]
            out[same] = np.minimum(out[same], of[a[same], i])
    return out


def linked_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """Per input row: vec_id, n_links (other rows with cosine >= threshold), component_id (smallest id reachable).

    Null and zero vectors and such with null or non-finite components link with nothing. Shorter vectors count
    as padded with zeros. Rows with equal directions are one node and link with each other. Every link
    is verified in double precision. A null id sorts last and stays null; rows that share an id are not linked
    by that. An empty table gives an empty result.

    Shards are clusters around centroids of a bounded sample; a vector joins its nearest OVERLAP. Each shard
    builds robust-pruned neighbour lists, which are united by vector. Cells (parts of a cluster, in
    pairs) run the searches, and a pair counts in the smallest cluster that both share. An audit draws vectors
    outside the sample until LINKED of them have links (DRAWN vectors at most) and compares them with all others;
    while too few links are found, vectors join twice as many clusters. Where that costs as much as comparing all
    vectors, all are compared, in pairs of blocks. Where links are so rare that only m < LINKED of the drawn vectors
    have any, the recall rests on these m: losing 3 / m of the linked vectors' links may then go unseen one time in
    twenty. The driver sees the sample (SAMPLE_BYTES) and the drawn vectors, CHUNK_BYTES at a time.
    """
    spark = vectors.sparkSession
    arrow_batches(spark)
    rows = vectors.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("embedding"),
    )
    dim = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    rows = rows.mapInArrow(_normal(max(dim, 1)), _VECTORS).withColumn("digest", F.sha2("vec", 256))
    rows = stored(rows, "graph-vectors")
    nodes = rows.where("vec is not null").groupBy("digest").agg(
        F.min("vec_id").alias("label"), F.count(F.lit(1)).alias("copies"), F.max("vec").alias("vec")
    )
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "graph-nodes")
    found = _found(nodes, threshold)
    labelled = lowest_labels(
        nodes.select("node", "label", "digest", "copies"),
        found.select(F.col("node").alias("u"), F.col("root").alias("v")),
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = labelled.join(links, "node", "left").select(
        "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    some = lambda c: F.when(c != NO_ID, c)
    return rows.join(nodes, "digest", "left").select(
        some(F.col("vec_id")).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        some(F.coalesce("component_id", "vec_id")).alias("component_id"),
    )


def _found(nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) of every cell; the audit decides whether the shards overlap enough."""
    spark = nodes.sparkSession
    n, width = nodes.agg(F.count(F.lit(1)), F.max(F.octet_length("vec"))).first()
    if not n:
        return spark.createDataFrame([], _CELL)
    k = min(MAX_CLUSTERS, max(1, n // CLUSTER))
    drawn = nodes.select("node", "vec", F.xxhash64("digest").alias("rank")).orderBy("rank")
    picked = drawn.limit(max(1, min(k * SAMPLE_PER_CLUSTER, SAMPLE_BYTES // width))).collect()
    sample = np.stack([np.frombuffer(r["vec"]) for r in picked])
    links = _audited(nodes, picked[-1]["rank"] if n > len(picked) else None, threshold)
    shared = spark.sparkContext.broadcast(centroids(sample, min(k, len(sample))))
    overlap = OVERLAP
    while True:
        found = stored(_searched(nodes, shared, overlap, threshold), "graph-found")
        if _recall(found, links) >= RECALL:
            break
        overlap *= 2
        if overlap >= k or CLUSTER * overlap**2 >= n:
            found = stored(_all_compared(nodes, n, width, threshold), "graph-compared")
            break
    shared.unpersist()
    return found


def _audited(nodes: DataFrame, sampled_to: int | None, threshold: float) -> dict[int, int]:
    """All links of vectors drawn outside the sample, of those that have any: a sampled vector is
    nearer to its centroid than others are. DRAWN vectors at most, whatever the table holds."""
    rank = F.xxhash64("digest", F.lit(1))
    others = nodes if sampled_to is None else nodes.where(F.xxhash64("digest") > sampled_to)
    links: dict[int, int] = {}
    for ids, vectors in _chunks(others.select("node", "vec", rank.alias("rank")), AUDITED, DRAWN):
        shared = nodes.sparkSession.sparkContext.broadcast((ids, vectors))
        linked = _compared(nodes, shared, threshold).where("links > 0").groupBy("node").agg(F.sum("links"))
        links.update(map(tuple, linked.collect()))
        shared.unpersist()
        if len(links) >= LINKED:
            break
    return links


def _recall(found: DataFrame, links: dict[int, int]) -> float:
    """The smaller of the share of the audited links that was found and the mean share by vector."""
    if not links:
        return 1.0
    audited = found.sparkSession.createDataFrame([(i,) for i in links], "node long")
    mine = dict(found.join(F.broadcast(audited), "node").groupBy("node").agg(F.sum("links")).collect())
    got, want = (np.array([x.get(i, 0) for i in links], float) for x in (mine, links))
    return float(min(got.sum() / want.sum(), (got / want).mean()))


def _chunks(ranked: DataFrame, first: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers and vectors of (node, vec, rank) by rank, `most` in all: `first` and then twice as many each time as
    far as they fit."""
    size, rest = min(first, most), ranked
    while size and (rows := rest.orderBy("rank").limit(size).collect()):
        vectors = np.stack([np.frombuffer(r["vec"]) for r in rows])
        yield np.array([r["node"] for r in rows]), vectors
        most -= len(rows)
        size = min(most, max(1, min(2 * size, CHUNK, CHUNK_BYTES // vectors[0].nbytes)))
        rest = ranked.where(F.col("rank") > rows[-1]["rank"])


def _links_between(left: tuple, right: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in left and right of the vectors that are linked, by blocked products in double precision."""
    (x, node_x), (y, node_y) = left, right
    found = [np.zeros((0, 2), np.int64)]
    for at in range(0, len(x), 512):
        near = (x[at : at + 512] @ y.T >= threshold) & (node_x[at : at + 512, None] != node_y)
        found.append(np.argwhere(near) + [at, 0])
    return tuple(np.concatenate(found).T)


def _compared(nodes: DataFrame, shared, threshold: float) -> DataFrame:
    """(node, links, root) of the broadcast vectors, by blocked products with every vector; vectors that they
    link with come with their root and no links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            node, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
            a, b = _links_between((_matrix(batch.column("vec")), node), (vectors, ids), threshold)
            links = np.bincount(b, weights=copies[a], minlength=len(ids)).astype(np.int64)
            members, roots = local_roots(node[a], ids[b])
            counts = dict(zip(ids.tolist(), links.tolist(), strict=True))
            arrays = members, np.array([counts.get(m, 0) for m in members.tolist()], np.int64), roots
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in arrays], names=["node", "links", "root"])

    return nodes.select("node", "copies", "vec").mapInArrow(run, _CELL)


def _block_pair(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        """Two blocks, or one with itself, whose vectors are all compared."""
        node, copies, block = (table.column(c).to_numpy() for c in ("node", "copies", "block"))
        x, first = _matrix(table.column("vec")), block == table.column("left")[0].as_py()
        mine, others = np.flatnonzero(first), np.flatnonzero(~first)
        if inner := not len(others):
            others = mine
        a, b = _links_between((x[mine], node[mine]), (x[others], node[others]), threshold)
        a, b = mine[a], others[b]
        links = np.bincount(a, weights=copies[b], minlength=len(node))
        if not inner:
            links += np.bincount(b, weights=copies[a], minlength=len(node))
        members, roots = local_roots(node[a], node[b])
        count = links[np.argsort(node)][np.searchsorted(np.sort(node), members)].astype(np.int64)
        return pa.table({"node": members, "links": count, "root": roots})

    return run


def _all_compared(nodes: DataFrame, n: int, width: int, threshold: float) -> DataFrame:
    """(node, links, root) of all vectors, exactly: blocks of bounded rows and bytes meet in pairs, each in a task."""
    blocks = -(-n // max(1, min(CHUNK, CHUNK_BYTES // width)))
    block = F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("block")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("other")
    cells = nodes.select("node", "copies", "vec", block, other)
    left, right = F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    cells = cells.select("node", "copies", "vec", "block", left, right)
    return cells.groupBy("left", "right").applyInArrow(_block_pair(threshold), _CELL)


def _searched(nodes: DataFrame, shared, overlap: int, threshold: float) -> DataFrame:
    spark = nodes.sparkSession
    schema = "node long, copies long, vec binary, clusters array<long>"
    assigned = stored(nodes.select("node", "copies", "vec").mapInArrow(_assigned(shared, overlap), schema), "graph-assigned")
    sizes = assigned.select(F.explode("clusters").alias("cluster")).groupBy("cluster").agg(
        F.ceil(F.count(F.lit(1)) / PART).alias("parts")
    )
    parts = F.broadcast(stored(sizes, "graph-sizes"))  # a row a cluster, MAX_CLUSTERS at most
    shards = assigned.withColumn("cluster", F.explode("clusters")).join(parts, "cluster")
    shards = shards.withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    lists = shards.groupBy("cluster", "part").applyInArrow(_graph, "node long, near array<long>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    shards = shards.join(stored(united, "graph-lists"), "node")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    cells = shards.select("*", other).select(
        "*", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right")
    )
    columns = "node", "copies", "vec", "clusters", "near", "cluster", "part", "left", "right"
    return cells.select(*columns).groupBy("cluster", "left", "right").applyInArrow(_linked(threshold), _CELL)
