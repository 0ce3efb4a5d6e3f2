"""Landing and bronze: raw rows kept as text, with lineage, under a content-addressed batch id."""

from __future__ import annotations

import uuid
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.config import BRONZE_SCHEMA, RAW_COLUMNS, shuffles_freed
from ticketlake.functions.casts import ntz, to_bigint
from ticketlake.operators.extract import created_at, newest_created
from ticketlake.operators.fingerprint import batch_id, json_line, row_digest
from ticketlake.sources import fs
from ticketlake.sources.files import read_jsonl, write_lines
from ticketlake.sources.log import RecordLog

# Columns that identify a stored row, and the file metadata they come from. They let staging keep
# unkeyed rows apart in a single pass, and are the same when a lost task is run again.
STORED_ROW_ID = {"_file": "file_path", "_row": "row_index"}

LINEAGE = ("ingest_date", "_batch_id")
# One record before a batch is written (not `stored`) and one after it.
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("ingest_date", T.DateType()),
        T.StructField("_batch_id", T.StringType()),
        T.StructField("_ingested_at", T.TimestampNTZType()),
        T.StructField("rows", T.LongType()),
        T.StructField("low_key", T.LongType()),
        T.StructField("high_key", T.LongType()),
        T.StructField("stored", T.BooleanType()),
    ]
)


class NoBronzeData(RuntimeError):
    """There is nothing in bronze to stage."""


class Batch(NamedTuple):
    """What a pull stored. `landing` and `batch_id` are None when the source had no rows."""

    rows: int
    batch_id: str | None = None
    newest: datetime | None = None
    landing: str | None = None
    low_key: int | None = None
    high_key: int | None = None


def bronze_path(root: str) -> str:
    return f"{root}/bronze"


def land(spark: SparkSession, rows: DataFrame, root: str) -> Batch:
    """Read the source once: write compressed JSON lines and observe count, newest row and content id.

    A row's JSON is made once; the line that is written is the one that is digested.

    The observation sits in the stage that writes, so each row is counted by the one task attempt
    that commits it. Every attempt has a folder of its own, which is neither moved nor shared: what an
    earlier attempt left half written is never read.
    """
    path = f"{root}/landing/{uuid.uuid4().hex}"
    seen, key = Observation(), to_bigint(F.col("unique_key"))
    observed = (
        rows.select(*RAW_COLUMNS)
        .withColumn("_line", json_line())
        .withColumn("_digest", row_digest(F.col("_line")))
        .observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            newest_created().cast("string").alias("newest"),
            batch_id(F.col("_digest")).alias("batch_id"),
            F.min(key).alias("low_key"),
            F.max(key).alias("high_key"),
        )
    )
    with shuffles_freed(spark):
        write_lines(observed, "_line", path)
    got = seen.get
    if not got["rows"]:
        fs.delete(spark, path)
        return Batch(0)
    newest = got["newest"] and datetime.fromisoformat(got["newest"])
    return Batch(got["rows"], got["batch_id"], newest, path, got["low_key"], got["high_key"])


def complete_until(spark: SparkSession, batch: Batch) -> datetime | None:
    """For a batch that a limit cut off: the newest creation time before its last one, which alone may be cut."""
    earlier = read_jsonl(spark, batch.landing).filter(created_at() < ntz(batch.newest))
    return earlier.agg(newest_created().alias("newest")).first()["newest"]


def with_lineage(rows: DataFrame, batch: str, source: str, ingested_at, ingest_date) -> DataFrame:
    return rows.select(
        *RAW_COLUMNS,
        F.lit(source).alias("_source"),
        ntz(ingested_at).alias("_ingested_at"),
        F.lit(str(ingest_date)).cast("date").alias("ingest_date"),
        F.lit(batch).alias("_batch_id"),
    )


def ingest(
    rows: DataFrame, root: str, *, ingest_date: date, ingested_at: datetime, source: str
) -> Batch:
    """Land the rows, then store them as Parquet under their date and batch id.

    The same rows on the same date replace their own partition; no rows write nothing. The manifest says before
    that the batch is being written, and after it that it is stored.
    """
    spark = rows.sparkSession
    batch = land(spark, rows, root)
    if not batch.rows:
        return batch
    log, entry = manifest(spark, root), {"ingest_date": ingest_date, "_batch_id": batch.batch_id}
    number = log.newest()[0] + 1
    log.append(number, entry | {"stored": False})
    stored = with_lineage(
        read_jsonl(spark, batch.landing), batch.batch_id, source, ingested_at, ingest_date
    )
    (
        stored.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("ingest_date", "_batch_id")
        .parquet(bronze_path(root))
    )
    keys = {"low_key": batch.low_key, "high_key": batch.high_key}
    log.append(number + 1, entry | {"_ingested_at": ingested_at, "rows": batch.rows, "stored": True} | keys)
    return batch


def manifest(spark: SparkSession, root: str) -> RecordLog:
    return RecordLog(spark, f"{root}/manifest", MANIFEST_SCHEMA, LINEAGE)


def batches(bronze: DataFrame) -> DataFrame:
    """(ingest_date, _batch_id, _ingested_at) of every stored batch, from the rows themselves."""
    return bronze.select(*LINEAGE, "_ingested_at").distinct()


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(ingest_date, _batch_id, _ingested_at, rows, low_key, high_key) of every stored batch, from the manifest.

    A batch whose writer stopped half way is looked at in its own partition, and the manifest is completed.
    """
    log = manifest(spark, root)
    for lost in log.rows().filter(~F.col("stored")).collect():  # one a crash
        here = scan(spark, root).filter((F.col("ingest_date") == lost["ingest_date"]) & (F.col("_batch_id") == lost["_batch_id"]))
        key = to_bigint(F.col("unique_key"))
        found = here.groupBy("_ingested_at").agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("low_key"), F.max(key).alias("high_key"))
        rows = [r.asDict() for r in found.collect()]  # one, as a batch is replaced as a whole
        for row in rows or [{"rows": 0}]:
            log.append(log.newest()[0] + 1, {c: lost[c] for c in LINEAGE} | row | {"stored": True})
    return log.rows().filter("rows > 0").select(*LINEAGE, "_ingested_at", "rows", "low_key", "high_key")


def scan(spark: SparkSession, root: str, row_id: bool = False) -> DataFrame:
    """Every batch as one relation; `row_id` adds the columns of STORED_ROW_ID."""
    if not fs.glob(spark, f"{bronze_path(root)}/ingest_date=*"):
        raise NoBronzeData(f"no bronze batches under {root}; ingest something first")
    table = spark.read.schema(BRONZE_SCHEMA).parquet(bronze_path(root))
    if not row_id:
        return table
    ids = [F.col(f"_metadata.{m}").alias(n) for n, m in STORED_ROW_ID.items()]
    return table.select("*", *ids)
