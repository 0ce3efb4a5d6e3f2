"""Line dedup: documents probe a sharded minimal perfect hash over all distinct lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import NO_ID, arrow_batches, documents, stored
from ticketlake.llm.perfect_hash import PerfectHash

STRIPPED = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 10, 2
# A block of documents asks once for each of its lines; a shard holds this many distinct lines.
BLOCK_BYTES, MIN_BLOCKS, SHARD_LINES = 64 << 20, 256, 200_000

_ASKED = "block int, key long, print long, first long, docs long"
_INDEX = "shard int, words binary, sizes binary, prints binary, counts binary, firsts binary"
_FOUND = "block int, key long, print long, first long"
_KEPT = "doc_id long, n_lines long, n_dropped long, text string"


def line_key(line: str, min_chars: int) -> tuple[int, int] | None:
    """128 bits of the stripped, A-Z lower-cased line as two signed halves; None for a short one."""
    key = line.strip(STRIPPED)
    if len(key) < min_chars:
        return None
    digest = xxhash.xxh3_128_digest(key.encode().lower())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _columns(schema: str, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=[c.split()[0] for c in schema.split(", ")])


def _ask(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked: dict[tuple, list[int]] = {}
            for block, doc, text in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "text")), strict=True):
                for key in {line_key(x, min_chars) for x in (text or "").split("\n")} - {None}:
                    entry = asked.setdefault((block, *key), [doc, 0])
                    entry[0], entry[1] = min(entry[0], doc), entry[1] + 1
            if asked:
                block, key, print_ = (np.array(x, np.int64) for x in zip(*asked, strict=True))
                first, docs = (np.array(x, np.int64) for x in zip(*asked.values(), strict=True))
                yield _columns(_ASKED, block.astype(np.int32), key, print_, first, docs)

    return run


def _build(table: pa.Table) -> pa.Table:
    """One shard of the index: perfect hash, fingerprints, document counts, smallest ids."""
    key, print_, first, docs = (table.column(c).to_numpy() for c in ("key", "print", "first", "docs"))
    index = PerfectHash.build(key, print_)
    slot = index.slots(key, print_)
    arrays = [np.zeros(len(key), np.int64) for _ in range(3)]
    for array, values in zip(arrays, (print_, docs, first), strict=True):
        array[slot] = values
    shard = pa.array([table.column("shard")[0].as_py()], pa.int32())
    stored_arrays = ([x.tobytes()] for x in (index.words, index.sizes, *arrays))
    return pa.Table.from_batches([_columns(_INDEX, shard, *stored_arrays)])


def _probe(min_docs: int):
    def run(asked: pa.Table, index: pa.Table) -> pa.Table:
        if not asked.num_rows or not index.num_rows:
            return pa.Table.from_batches([_columns(_FOUND, np.zeros(0, np.int32), *[np.zeros(0, np.int64)] * 3)])
        row = index.to_pylist()[0]
        hashed = PerfectHash(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["sizes"], np.int64))
        prints, counts, firsts = (np.frombuffer(row[c], np.int64) for c in ("prints", "counts", "firsts"))
        block, key, print_ = (asked.column(c).to_numpy() for c in ("block", "key", "print"))
        slot = hashed.slots(key, print_)
        found = (slot >= 0) & (prints[slot] == print_) & (counts[slot] >= min_docs)
        return pa.Table.from_batches([_columns(_FOUND, block[found], key[found], print_[found], firsts[slot[found]])])

    return run


def _drop(min_chars: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        key, print_, first = (found.column(c).to_pylist() for c in ("key", "print", "first"))
        holder = dict(zip(zip(key, print_, strict=True), first, strict=True))
        out = []
        for doc, text in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist(), strict=True):
            lines = (text or "").split("\n")
            kept = [x for x in lines if holder.get(line_key(x, min_chars), NO_ID) >= doc]
            out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
        ids, n, dropped, texts = zip(*out, strict=True) if out else ([], [], [], [])
        longs = [pa.array(x, pa.int64()) for x in (ids, n, dropped)]
        return pa.Table.from_arrays([*longs, pa.array(texts, pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])

    return run


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Per input row: doc_id, n_lines, n_dropped, text without its repeated lines.

    Lines compare by their text stripped of ASCII white space and lower-cased in A-Z. One of at least
    min_chars code points that min_docs documents hold stays only in the document of smallest id.
    A null or empty text is one empty line. Rows that share an id count as one document; a null id
    counts as the largest. An empty table gives an empty result; other columns are not read.

    1. Blocks of documents (by a hash of the id) list their distinct lines as 128-bit hashes.
    2. The distinct hashes are dealt to shards; each becomes a minimal perfect hash with arrays of
       fingerprints, document counts and smallest ids, stored as one row.
    3. The blocks' lists probe the arrays of each shard: a line asks once per block, however many
       documents hold it, so a line of every document loads no shard.
    4. Each block's documents meet the answers for that block.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = documents(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(MIN_BLOCKS, -(-size // BLOCK_BYTES))
    doc_id = F.coalesce("doc_id", F.lit(NO_ID))
    rows = rows.select(F.pmod(F.xxhash64(doc_id), F.lit(blocks)).cast("int").alias("block"), doc_id.alias("doc_id"), "text")

    asked = rows.mapInArrow(_ask(min_chars), _ASKED).groupBy("block", "key", "print")
    asked = stored(asked.agg(F.min("first").alias("first"), F.sum("docs").alias("docs")), "lines-asked")
    lines = asked.groupBy("key", "print").agg(F.min("first").alias("first"), F.sum("docs").alias("docs"))
    shards = max(1, -(-(asked.agg(F.approx_count_distinct("key")).first()[0]) // SHARD_LINES))
    shards = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shard = F.pmod("key", F.lit(shards)).cast("int")
    index = stored(lines.withColumn("shard", shard).groupBy("shard").applyInArrow(_build, _INDEX), "lines-index")
    found = (
        asked.withColumn("shard", shard)
        .groupBy("shard")
        .cogroup(index.groupBy("shard"))
        .applyInArrow(_probe(min_docs), _FOUND)
    )
    kept = rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_drop(min_chars), _KEPT)
    return kept.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
