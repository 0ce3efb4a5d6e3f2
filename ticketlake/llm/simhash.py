"""SimHash near-dedup: fingerprints of whole texts, linked through Gray-ordered hierarchical indexes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import NO_ID, arrow_batches, documents, keep_rows, stored
from ticketlake.llm.components import local_roots, lowest_labels

BITS = 64
SEED = 42
# A table of the join keeps some of the blocks the bits are cut into; a pair within the distance agrees on one of them.
BLOCKS = 6
# Members of a Gray-ordered run that share one node, and children of an upper node.
LEAF, FANOUT = 16, 8
# Groups above this size are dealt again by more agreeing bits.
GROUP = 2000

_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()
"""Each value of a byte as eight counters of eight bits, lowest bit first."""


def fingerprint(text: bytes, shingle: int) -> int:
    """A bit is one if more than half of the shingles' hashes have it; no words give zero."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    joined = [b" ".join(x) for x in zip(*(words[i:] for i in range(shingle)), strict=False)] or [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(x, SEED) for x in joined), "<u8", len(joined))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255 * 64):
        lanes = _SPREAD[hashes[at : at + 255 * 64].view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255))  # 255 rows can't overflow a counter
        counts += sums.view(np.uint8).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little", signed=True)


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint((x or "").encode(), shingle) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hash"), pa.array(values, pa.int64())],
                names=["doc_id", "hash", "fingerprint"],
            )

    return run


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each bit pattern in the binary-reflected Gray order."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints in Gray order under a hierarchy of masked patterns.

    A node holds the bits on which all its members agree (mask, pattern). Bits that an ancestor has
    already factored out are left out of a node's mask, so the differences met on the way down add up,
    and a whole group is passed by once they exceed the distance.
    """

    def __init__(self, values: np.ndarray):
        self.order = np.argsort(gray_rank(values), kind="stable")
        members = values[self.order]
        spans = np.arange(0, len(members), LEAF)
        both, any_ = np.bitwise_and.reduceat(members, spans), np.bitwise_or.reduceat(members, spans)
        self.levels = [(both, both | ~any_)]  # pattern, mask of agreement
        while len(both) > FANOUT:
            spans = np.arange(0, len(both), FANOUT)
            both, any_ = np.bitwise_and.reduceat(both, spans), np.bitwise_or.reduceat(any_, spans)
            self.levels.append((both, both | ~any_))
        self.levels.reverse()
        factored = []
        for depth, (pattern, mask) in enumerate(self.levels):
            above = np.repeat(self.levels[depth - 1][1], FANOUT)[: len(mask)] if depth else np.zeros_like(mask)
            factored.append((pattern, mask & ~above))
        self.levels, self.members = factored, members
        leaf_mask = np.repeat(self._agreed(), LEAF)[: len(members)]
        self.own = ~leaf_mask

    def _agreed(self) -> np.ndarray:
        """Per lowest node, all bits factored out on its way."""
        agreed = self.levels[0][1]
        for _, mask in self.levels[1:]:
            agreed = np.repeat(agreed, FANOUT)[: len(mask)] | mask
        return agreed

    def near(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query position, member position in the given order) within the distance."""
        pattern, mask = self.levels[0]
        who = np.repeat(np.arange(len(queries)), len(pattern))
        node = np.tile(np.arange(len(pattern)), len(queries))
        differ = np.zeros(len(who), np.int64)
        for depth, (pattern, mask) in enumerate(self.levels):
            if depth:
                who, differ, node = self._children(who, differ, node, FANOUT, len(pattern))
            differ = differ + np.bitwise_count((queries[who] ^ pattern[node]) & mask[node])
            close = differ <= distance
            who, node, differ = who[close], node[close], differ[close]
        who, differ, at = self._children(who, differ, node, LEAF, len(self.members))
        differ = differ + np.bitwise_count((queries[who] ^ self.members[at]) & self.own[at])
        close = differ <= distance
        return who[close], self.order[at[close]]

    @staticmethod
    def _children(who, differ, node, width, end):
        child = (node[:, None] * width + np.arange(width)).ravel()
        inside = child < end
        return np.repeat(who, width)[inside], np.repeat(differ, width)[inside], child[inside]


def _linked(distance: int):
    """Inside one group: each fingerprint with the root of what it reaches there, itself left out."""

    def run(table: pa.Table) -> pa.Table:
        value, node = (table.column(c).to_numpy() for c in ("fingerprint", "node"))
        bits = value.view(np.uint64)
        index, left, right = GrayIndex(bits), [], []
        for at in range(0, len(bits), 256):
            who, other = index.near(bits[at : at + 256], distance)
            left.append(node[who + at])
            right.append(node[other])
        member, root = local_roots(np.concatenate(left), np.concatenate(right))
        far = member != root
        return pa.table({"u": pa.array(member[far], pa.int64()), "v": pa.array(root[far], pa.int64())})

    return run


def _masks(free: int, distance: int) -> list[int]:
    """Bit masks of all ways to leave `distance` of BLOCKS blocks of the given bits out."""
    bits = [i for i in range(BITS) if free >> i & 1]
    cut = [bits[len(bits) * i // BLOCKS : len(bits) * (i + 1) // BLOCKS] for i in range(BLOCKS)]
    fixed = ~free & (1 << BITS) - 1
    return [
        fixed | sum(1 << i for block in kept for i in block) for kept in combinations(cut, BLOCKS - distance)
    ]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> BITS - 1 else x


def _tables(values: DataFrame, masks: list[int]) -> DataFrame:
    keyed = F.array(
        *(
            F.struct(F.lit(_signed(m)).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for m in masks
        )
    )
    return values.select(F.inline(keyed), "fingerprint", "node")


def _group_links(distance: int):
    linked = _linked(distance)

    def run(table: pa.Table) -> pa.Table:
        """A bucket of whole groups, each searched through an index of its own."""
        table = table.sort_by([("mask", "ascending"), ("key", "ascending")])
        mask, key = (table.column(c).to_numpy() for c in ("mask", "key"))
        new = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        starts = np.concatenate([[0], new, [len(mask)]])
        parts = [
            linked(table.slice(at, end - at))
            for at, end in zip(starts[:-1], starts[1:], strict=True)
            if end - at > 1
        ]
        return pa.concat_tables(parts) if parts else linked(table.slice(0, 0))

    return run


def links(values: DataFrame, distance: int) -> DataFrame:
    """Links (u, v) between nodes that connect all fingerprints within the distance of each other.

    values: fingerprint (distinct), node. A pair within the distance agrees on one of the ways to keep
    BLOCKS - distance of BLOCKS blocks, so equal kept bits gather candidates in groups. A group above
    GROUP members is dealt again by blocks of the bits that it leaves free, until groups are small;
    as fingerprints are distinct, one that agrees on 56 bits has 256 members at most.
    """
    spark = values.sparkSession
    if not 0 <= distance < BLOCKS:
        raise ValueError(f"distance must lie in 0..{BLOCKS - 1}")
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level = [(_signed(m), m) for m in _masks((1 << BITS) - 1, distance)]
    rows = _tables(values, [m for _, m in level])
    found = None
    while True:
        sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = stored(rows.join(sizes, ["mask", "key"]), "simhash-groups")
        n_rows = sized.count()
        buckets = max(8 * parallel, n_rows // 50_000)
        small = sized.where(F.col("size") <= GROUP).withColumn(
            "bucket", F.pmod(F.xxhash64("mask", "key"), F.lit(buckets))
        )
        edges = small.groupBy("bucket").applyInArrow(_group_links(distance), "u long, v long")
        found = edges if found is None else found.union(edges)
        large = sized.where(F.col("size") > GROUP)
        if large.isEmpty():
            return found
        finer = [(old, _signed(m)) for old, mask in level for m in _masks(~mask & (1 << BITS) - 1, distance)]
        level = [(m, m & (1 << BITS) - 1) for m in sorted({m for _, m in finer})]
        finer = F.broadcast(spark.createDataFrame(finer, "mask long, finer long"))
        rows = large.join(finer, "mask").select(
            F.col("finer").alias("mask"), F.col("fingerprint").bitwiseAND(F.col("finer")).alias("key"), "fingerprint", "node"
        )
        rows = rows.distinct()


def _grouped(docs: DataFrame, shingle: int, distance: int, id_col: str, text_col: str) -> DataFrame:
    """Per input row doc_id (NO_ID for null), hash of the text, fingerprint, root and component_id."""
    arrow_batches(docs.sparkSession)
    rows = documents(docs, id_col, text_col, F.xxhash64(F.col(text_col)).alias("hash"))
    rows = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    rows = stored(rows.mapInArrow(_fingerprints(shingle), "doc_id long, hash long, fingerprint long"), "simhash-rows")
    values = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("label"))
    values = stored(values.withColumn("node", F.monotonically_increasing_id()), "simhash-values")
    values = lowest_labels(values, links(values.select("fingerprint", "node"), distance))
    return rows.join(values.select("fingerprint", "root", "component_id"), "fingerprint")


def simhash_groups(
    docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: doc_id, fingerprint (long), component_id (smallest id reachable over links).

    Fingerprints take whole texts: words between ASCII white space, lower-cased in A-Z, in shingles of
    `shingle` words (fewer words: all of them as one; none: fingerprint zero), XXH64 with seed 42. Equal
    fingerprints are one node, so copies cost nothing; null texts have fingerprint zero like empty ones.
    A null id sorts last and stays null; rows that share an id are not linked by that. An empty table
    gives an empty result. Other columns are not read.
    """
    some = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    rows = _grouped(docs, shingle, distance, id_col, text_col)
    return rows.select(some("doc_id"), "fingerprint", some("component_id"))


def drop_near_duplicates(
    docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The row of smallest id of every group, with all its columns.

    Of rows with this id the text of smallest hash stays, and rows that repeat id and text become one.
    """
    rows = _grouped(docs, shingle, distance, id_col, text_col)
    first = rows.groupBy("root").agg(F.min(F.struct("doc_id", "hash")).alias("first")).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.hash").alias("kept_hash")
    )
    first = stored(first, "simhash-kept")
    doc_id = F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID))
    rows = keep_rows(docs, first, ("kept_id", doc_id), ("kept_hash", F.xxhash64(docs[text_col])))
    return rows.dropDuplicates([id_col, text_col])
