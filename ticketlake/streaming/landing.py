"""Incremental bronze ingest of landing files with Structured Streaming."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ticketlake.config import RAW_SCHEMA
from ticketlake.sources import bronze, fs


def epoch_time(spark: SparkSession, folder: str, epoch: int, now: datetime) -> datetime:
    """The ingest time of a micro-batch: fixed by the first attempt that stored one."""
    path = f"{folder}/epoch={epoch}"
    if not fs.exists(spark, f"{path}/_SUCCESS"):
        one = spark.createDataFrame([(now,)], "at timestamp_ntz").coalesce(1)
        one.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).first()["at"]


def ingest_new_files(
    spark: SparkSession,
    drop_folder: str,
    root: str,
    checkpoint: str,
    *,
    ingested_at: datetime,
    source: str,
    max_files_per_batch: int | None = None,
) -> int:
    """Ingest the JSON-lines files that arrived since the last call, then stop; returns rows.

    The checkpoint remembers which files are done. A micro-batch that is replayed after a failure has the
    same rows, hence the same batch id, and takes the time of its first attempt, which is stored beside the
    checkpoint: it replaces its own partition, also on another day.
    """
    ingested = []

    def to_bronze(rows: DataFrame, epoch: int) -> None:
        at = epoch_time(spark, f"{checkpoint.rstrip('/')}-times", epoch, ingested_at)
        batch = bronze.ingest(rows, root, ingest_date=at.date(), ingested_at=at, source=source)
        ingested.append(batch.rows)

    stream = spark.readStream.schema(RAW_SCHEMA).option("mode", "FAILFAST")
    if max_files_per_batch:
        stream = stream.option("maxFilesPerTrigger", max_files_per_batch)
    query = (
        stream.json(drop_folder)
        .writeStream.foreachBatch(to_bronze)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(ingested)
