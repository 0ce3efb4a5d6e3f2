"""Sharding: sampled splitters cut the records' order into ranges; running sizes in them give the shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.common import NO_ID, arrow_batches, documents, stored

OVERHEAD = 8
"""Bytes a record takes besides its text."""

# Ranges a shard is cut into at least, rows a range holds on average at most, keys sampled for each range.
RANGES_PER_SHARD, RANGE_ROWS, SAMPLES = 16, 1_000_000, 32
# A range above this many times the mean, in bytes or rows, is subdivided, at most so often.
OVERFULL, MAX_ROUNDS = 1.5, 4

_KEY_BYTES = 32


def _ranges(splitters: list[bytes]):
    """Number of splitters at or below each key: its range."""
    cuts = np.array(splitters, dtype=f"S{_KEY_BYTES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("order_key").cast(pa.binary(_KEY_BYTES))
            start = keys.offset * _KEY_BYTES
            raw = np.frombuffer(keys.buffers()[1], np.uint8)[start : start + len(keys) * _KEY_BYTES]
            found = np.searchsorted(cuts, raw.view(f"S{_KEY_BYTES}"), side="right")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "range"]
            )

    return run


def _quantiles(sample: list[tuple[bytes, float]], pieces: int) -> set[bytes]:
    """Keys that cut the sampled weight into equal pieces."""
    sample = sorted(sample)
    weight = np.cumsum([w for _, w in sample])
    if not len(weight):
        return set()
    at = np.searchsorted(weight, np.arange(1, pieces) * weight[-1] / pieces)
    return {sample[i][0] for i in np.unique(np.minimum(at, len(sample) - 1))}


def _sample(rows: DataFrame, total: int, wanted: int) -> list[tuple[bytes, float]]:
    """About `wanted` keys, each drawn with a chance that follows its size, and the weight it stands for."""
    chance = F.least(F.lit(1.0), F.col("size") * (wanted / total))
    drawn = F.pmod(F.xxhash64("order_key"), F.lit(1 << 40)) / float(1 << 40) < chance
    picked = rows.where(drawn).select("order_key", (F.col("size") / chance).alias("weight"))
    return [(bytes(r[0]), r[1]) for r in picked.collect()]


def shard(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, size, text_crc32, shard (0..n_shards-1), slot (gapless from 0 in the shard).

    Law: shards have nearly equal bytes. Records are ordered by the digest of their text, then id, then
    row, so equal texts lie together; record r goes to shard floor(bytes before r * n_shards / all
    bytes). Two shards differ by less than the two records at their ends; a record larger than a share
    leaves shards empty. The result doesn't depend on the sample, only the spread of the work does.

    A null text has no bytes (CRC 0) and sorts with the empty ones; a null id sorts last; rows repeated
    in full get slots of their own. An empty table gives an empty result. Other columns are not read.

    A size-weighted sample of keys gives quantile boundaries; records are dealt to the ranges between
    them. Ranges that turn out overfull in bytes or rows are sampled again and subdivided; as the id
    and the row belong to the key, copies of one text can be cut too. Totals of the ranges (their
    number follows the rows, one per RANGE_ROWS) go through the driver.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    raw = documents(docs, id_col, text_col)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    doc_id = F.coalesce("doc_id", F.lit(NO_ID))
    big_endian = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    rows = raw.withColumn("row", F.monotonically_increasing_id()).select(
        "doc_id",
        (F.octet_length(data) + OVERHEAD).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.concat(
            F.unhex(F.md5(data)), big_endian(doc_id.bitwiseXOR(F.lit(-(2**63)))), big_endian(F.col("row"))
        ).alias("order_key"),
    )
    rows = stored(rows, "shard-rows")
    n_rows, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not n_rows:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    n_ranges = max(n_shards * RANGES_PER_SHARD, -(-n_rows // RANGE_ROWS))
    splitters = _quantiles(_sample(rows, total, n_ranges * SAMPLES), n_ranges)
    for _ in range(MAX_ROUNDS):
        ranged = rows.mapInArrow(_ranges(sorted(splitters)), f"{_ddl(rows)}, range long")
        filled = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
        pieces = {r["range"]: int(np.ceil(max(r["bytes"] * n_ranges / total, r["rows"] * n_ranges / n_rows))) for r in filled}
        over = {k: p for k, p in pieces.items() if p > OVERFULL}
        if not over:
            break
        splitters |= _subdivide(ranged, over, {r["range"]: r["rows"] for r in filled})

    ranged = rows.mapInArrow(_ranges(sorted(splitters)), f"{_ddl(rows)}, range long")
    ranged = stored(ranged, "shard-ranges")
    return _placed(ranged, n_shards, total)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _subdivide(ranged: DataFrame, over: dict[int, int], n_rows: dict[int, int]) -> set[bytes]:
    """New splitters inside overfull ranges, from a sample by rows of those ranges alone."""
    spark = ranged.sparkSession
    chances = [(k, min(1.0, p * SAMPLES / n_rows[k])) for k, p in over.items()]
    wanted = F.broadcast(spark.createDataFrame(chances, "range long, chance double"))
    drawn = F.pmod(F.xxhash64("order_key", F.lit(len(over))), F.lit(1 << 40)) / float(1 << 40) < F.col("chance")
    keys: dict[int, list[tuple[bytes, float]]] = {}
    for r in ranged.join(wanted, "range").where(drawn).select("range", "order_key", "size").collect():
        keys.setdefault(r["range"], []).append((bytes(r["order_key"]), 1.0))
    return set().union(*(_quantiles(sample, over[k]) for k, sample in keys.items()))


def _placed(ranged: DataFrame, n_shards: int, total: int) -> DataFrame:
    spark = ranged.sparkSession
    totals = ranged.groupBy("range").agg(F.sum("size"), F.count(F.lit(1))).collect()
    offsets, bytes_before, rows_before = [], 0, 0
    for range_, size, count in sorted(totals):
        offsets.append((range_, bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + size, rows_before + count
    offsets = F.broadcast(spark.createDataFrame(offsets, "range long, bytes_before long, rows_before long"))

    order = Window.partitionBy("range").orderBy("order_key")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = ranged.select("*", before.alias("before"), F.row_number().over(order).alias("nth"))
    placed = placed.join(offsets, "range").select(
        "doc_id",
        "size",
        "text_crc32",
        F.expr(f"int((before + bytes_before) * {n_shards} div {total})").alias("shard"),
        (F.col("nth") + F.col("rows_before") - 1).alias("position"),
    )
    placed = stored(placed, "shard-placed")
    starts = F.broadcast(placed.groupBy("shard").agg(F.min("position").alias("start")))
    return placed.join(starts, "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("start")).alias("slot")
    )
