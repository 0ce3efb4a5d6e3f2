"""CSV and JSON-lines scans and the landing sink, all under the declared raw schema."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.config import RAW_COLUMNS, RAW_SCHEMA

# JSON lines are ten times the size of the same rows as Parquet; this codec costs less time than the bytes it saves.
LANDING_CODEC = "lz4"
ROWS_A_FILE = 1_000_000


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of every file that has one, found by tasks of a plain text scan.

    A task stops at its first rows where its block can't be followed by another file; so of large files only the
    beginnings of blocks are read. Files that share a task are read to their end; under `file_a_task` none do.
    """
    largest, opening = (_bytes(spark, f"spark.sql.files.{name}") for name in ("maxPartitionBytes", "openCostInBytes"))

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in batches:
            files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
            new = [i for i, f in enumerate(files) if starts[i] == 0 and f not in met and not met.add(f)]
            yield batch.take(pa.array(new, pa.int64())).select(["file", "header"])
            if files and batch.column("length")[-1].as_py() + opening >= largest:
                return

    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.col("value").alias("header"),
    )
    return lines.mapInArrow(first_lines, "file string, header string")


@contextmanager
def file_a_task(spark: SparkSession) -> Iterator[None]:
    """Scans that run meanwhile put no two files into one task."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(_bytes(spark, "spark.sql.files.maxPartitionBytes")))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _bytes(spark: SparkSession, setting: str) -> int:
    """A size setting, which Spark gives as a number with or without a unit."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", spark.conf.get(setting).strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def _plain_path(uri: str) -> str:
    """A file's address as a path to read: without percent signs, and with no character that stands for others."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Columns by header name, every empty cell missing, absent columns NULL, others dropped.

    Files may order or choose their columns differently: tasks find the first line of every file, and files with
    one header are read together. The driver sees a row a distinct header and, where there are several, the names of
    their files. A line with more or fewer cells than its header, or a header that names a column twice, fails the
    read. `path` may hold wildcards or name a folder. `multiline` accepts line breaks inside quoted cells, at
    the price of unsplittable files.
    """
    with file_a_task(spark):
        found = header_lines(spark, path).withColumn("header", F.regexp_replace("header", "^\ufeff", ""))
        headers = [r["header"] for r in found.select("header").distinct().collect()]
        if len(headers) > 1:  # looked up once, each header reads its own files
            groups = found.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
            by_header = {r["header"]: sorted(map(_plain_path, r["files"])) for r in groups}
        else:
            by_header = dict.fromkeys(headers, [path])
    table = spark.createDataFrame([], RAW_SCHEMA)
    for line, files in sorted(by_header.items()):
        header = tuple(next(csv.reader([line]), ()))
        if len(set(header)) < len(header):
            raise ValueError(f"a column name occurs twice in the header {line!r}")
        if not header:
            continue
        names = T.StructType([T.StructField(c, T.StringType()) for c in header])
        rows = spark.read.schema(names).csv(
            files, header=True, multiLine=multiline, escape='"', mode="FAILFAST", enforceSchema=False
        )
        table = table.unionByName(rows.select(*[_cell(c, header) for c in RAW_COLUMNS]))
    return table


def _cell(name: str, header: tuple[str, ...]) -> Column:
    value = F.nullif(F.col(f"`{name}`"), F.lit("")) if name in header else F.lit(None).cast("string")
    return value.alias(name)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Absent fields become NULL; a malformed line fails the read instead of becoming a NULL row."""
    return spark.read.schema(RAW_SCHEMA).option("mode", "FAILFAST").json(path)


def write_jsonl(rows: DataFrame, path: str, compression: str = "none") -> None:
    """One object per line, fields in name order, missing fields left out."""
    lines = rows.select(*sorted(RAW_COLUMNS)).write.option("ignoreNullFields", True)
    lines.options(**output(compression)).json(path)


def write_lines(rows: DataFrame, line: str, path: str) -> None:
    """The landing's form of `write_jsonl`: rows that bring their JSON line, compressed."""
    rows.select(F.col(line).alias("value")).write.options(**output(LANDING_CODEC)).text(path)


def output(compression: str) -> dict[str, str]:
    """A compressed file is read by one task, so it holds a bounded number of rows."""
    return {"compression": compression} | ({} if compression == "none" else {"maxRecordsPerFile": str(ROWS_A_FILE)})
