"""Layout of a lake, its run log, and how readers find the published tables.

    landing/<attempt>/                             raw rows as JSON lines, one folder per pull
    bronze/ingest_date=<day>/_batch_id=<batch>/    raw rows as Parquet
    manifest/<number>-<attempt>/                   one record before and after each bronze batch (a log)
    buckets/run=<id>/bucket=<n>/layer=<layer>/     judged rows that a run wrote; layers silver and quarantine
    staged/run=<id>/                               the buckets of a run: which run wrote each, and its counts
    batches/run=<id>/                              bronze batches that run had staged
    gold/<mart>/run=<id>/                          marts of one run or rebuild
    runs/<number>-<attempt>/                       one record per run or rebuild, written last (a log)

A run writes under its own id and becomes visible when its record is written: one file in a folder
that no other attempt uses. One that stops half way, also while it writes the record, leaves nothing a
reader would look at and nothing in the way of the next run. Both logs are compacted (sources/log.py).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.config import (
    BUCKET_SCHEMA,
    MART_NAMES,
    MART_SCHEMAS,
    QUARANTINE_SCHEMA,
    SILVER_SCHEMA,
    STAGED_SCHEMA,
)
from ticketlake.sources import bronze, fs
from ticketlake.sources.log import RecordLog

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("since", T.TimestampNTZType()),
        T.StructField("fetched", T.LongType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("silver_rows", T.LongType()),
        T.StructField("good_rows", T.LongType()),
        T.StructField("quarantined", T.LongType()),
        T.StructField("fail_rate", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("rule_failures", T.MapType(T.StringType(), T.LongType())),
        T.StructField("gold_rows", T.MapType(T.StringType(), T.LongType())),
        T.StructField("watermark", T.TimestampNTZType()),
        T.StructField("published_run", T.StringType()),
        T.StructField("staged_run", T.StringType()),
        T.StructField("marts_run", T.StringType()),
        T.StructField("landing", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)
PUBLISHED, FAILED, REBUILT = "published", "failed", "rebuilt"


NEVER_RAN = Row(**dict.fromkeys([*RUN_SCHEMA.fieldNames()]))


class NotPublished(FileNotFoundError):
    """The lake has no published run yet."""


class TwoRecords(RuntimeError):
    """Two runs committed under one number: they ran at the same time. Delete the record of one."""


@dataclass(frozen=True)
class Buckets:
    """The buckets of one run's staging."""

    rows: tuple[Row, ...]

    @property
    def versions(self) -> dict[int, str]:
        return {r["bucket"]: r["version"] for r in self.rows}

    def fits(self, buckets: int, judged_by: str) -> bool:
        """May these be merged with rows that are dealt and judged like that?"""
        return all((r["buckets"], r["judged_by"]) == (buckets, judged_by) for r in self.rows)

    def counts(self, rules: tuple[str, ...]) -> dict[str, int]:
        """What the gate counts: rows, rows with a violation, violations per rule."""
        out = {n: sum(r[n] for r in self.rows) for n in ("total", "failed")}
        return out | {rule: sum(r["rules"].get(rule, 0) for r in self.rows) for rule in rules}


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = RecordLog(spark, f"{self.root}/runs", RUN_SCHEMA)

    # paths
    def staged_path(self, run_id: str) -> str:
        return f"{self.root}/staged/run={run_id}"

    def buckets_path(self, run_id: str) -> str:
        return f"{self.root}/buckets/run={run_id}"

    def batches_path(self, run_id: str) -> str:
        return f"{self.root}/batches/run={run_id}"

    def gold_path(self, mart: str, run_id: str) -> str:
        return f"{self.root}/gold/{mart}/run={run_id}"

    # run log
    def run_log(self) -> DataFrame:
        """One row per run or rebuild of marts, oldest first by `seq`."""
        return self.log.rows()

    def state(self, new_run: str | None = None) -> Row:
        """The newest record, found by name, or NEVER_RAN; refuses `new_run` if a finished run already has that id."""
        number, files = self.log.newest()
        if not files:
            return NEVER_RAN
        numbers = [n for n, _ in self.log.entries()]
        if len(set(numbers)) < len(numbers):
            raise TwoRecords(f"a number occurs twice in {self.root}/runs")
        if new_run is not None and not self.run_log().filter(F.col("run_id") == new_run).isEmpty():
            raise ValueError(f"run id {new_run!r} is taken; a finished run is never overwritten")
        return self.log.record(files[0])

    def record(self, before: Row, **values) -> Row:
        """Append a record behind the newest one; the commit point of a run. Returns it."""
        return self.log.append((before["seq"] or 0) + 1, values)

    def published(self) -> Row:
        """The newest record, which names the visible run and the marts that go with it."""
        return self.visible().record

    def published_run(self) -> str:
        return self.published()["published_run"]

    def published_record(self) -> Row:
        """The record of the visible run itself."""
        return self.run_log().filter(F.col("run_id") == self.published_run()).first()

    def visible(self) -> Visible:
        """All tables that the newest record shows, looked up once."""
        state = self.state()
        if state["published_run"] is None:
            raise NotPublished(f"nothing is published under {self.root}; run the lake first")
        return Visible(self, state)

    # tables
    def bronze(self, row_id: bool = False) -> DataFrame:
        return bronze.scan(self.spark, self.root, row_id)

    def buckets(self, run_id: str) -> Buckets:
        """One row a bucket, as many as the lake has buckets."""
        return Buckets(tuple(self.spark.read.schema(BUCKET_SCHEMA).parquet(self.staged_path(run_id)).collect()))

    def staged(self, buckets: Buckets, only: set[int] | None = None) -> DataFrame:
        """The judged rows of these buckets, or of some of them; other versions' folders are not looked at."""
        by_run: dict[str, list[int]] = {}
        for bucket, version in sorted(buckets.versions.items()):
            if only is None or bucket in only:
                by_run.setdefault(version, []).append(bucket)
        paths = [f"{self.buckets_path(v)}/bucket={{{','.join(map(str, some))}}}" for v, some in by_run.items()]
        if not paths:
            return self.spark.createDataFrame([], STAGED_SCHEMA)
        reader = self.spark.read.schema(STAGED_SCHEMA).option("basePath", f"{self.root}/buckets")
        return reader.parquet(*paths).select(*STAGED_SCHEMA.fieldNames())

    def silver(self, run_id: str | None = None) -> DataFrame:
        """Published rows; only the good layer's files are read."""
        return _good(self.staged(self.buckets(run_id))) if run_id else self.visible().silver()

    def quarantine(self, run_id: str | None = None) -> DataFrame:
        """Rows a run rejected; by default those of the published run."""
        return _rejected(self.staged(self.buckets(run_id))) if run_id else self.visible().quarantine()

    def mart(self, name: str, run_id: str | None = None) -> DataFrame:
        path = self.gold_path(name, run_id or self.published()["marts_run"])
        return self.spark.read.schema(MART_SCHEMAS[name]).parquet(path)

    def expire(self, keep: tuple[str, ...] = ()) -> list[str]:
        """Delete tables of runs and rebuilds that are neither visible, nor the last staging, nor in `keep`, buckets
        that none of these runs has, and landing folders that no record names."""
        state = self.state()
        live = {state["published_run"], state["staged_run"], state["marts_run"], *keep}
        patterns = ["staged/run=*", "batches/run=*", *[f"gold/{m}/run=*" for m in MART_NAMES]]
        found = [p for pattern in patterns for p in fs.glob(self.spark, f"{self.root}/{pattern}")]
        dead = [p for p in found if p.rsplit("run=", 1)[1] not in live]
        dead += self._dead_buckets(live)
        landed = {r["landing"].rsplit("/", 1)[1] for r in self.run_log().select("landing").collect() if r["landing"]}
        dead += [p for p in fs.glob(self.spark, f"{self.root}/landing/*") if p.rsplit("/", 1)[1] not in landed]
        for path in dead:
            fs.delete(self.spark, path)
        return dead

    def _dead_buckets(self, live: set[str | None]) -> list[str]:
        staged = [p.rsplit("run=", 1)[1] for p in fs.glob(self.spark, f"{self.root}/staged/run=*")]
        used = {(v, b) for run_id in staged if run_id in live for b, v in self.buckets(run_id).versions.items()}
        dead = []
        for path in fs.glob(self.spark, f"{self.root}/buckets/run=*"):
            run_id = path.rsplit("run=", 1)[1]
            if not any(v == run_id for v, _ in used):
                dead.append(path)
                continue
            for bucket in fs.glob(self.spark, f"{path}/bucket=*"):
                if (run_id, int(bucket.rsplit("=", 1)[1])) not in used:
                    dead.append(bucket)
        return dead


def _good(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("layer") == "silver").select(*SILVER_SCHEMA.fieldNames())


def _rejected(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("layer") == "quarantine").select(*QUARANTINE_SCHEMA.fieldNames())


class Visible:
    """What one record of the log shows. Its tables belong together, also while later runs commit."""

    def __init__(self, lake: Lake, record: Row):
        self.lake, self.record = lake, record

    @cached_property
    def buckets(self) -> Buckets:
        return self.lake.buckets(self.record["published_run"])

    def silver(self) -> DataFrame:
        return _good(self.lake.staged(self.buckets))

    def quarantine(self) -> DataFrame:
        return _rejected(self.lake.staged(self.buckets))

    def mart(self, name: str) -> DataFrame:
        return self.lake.mart(name, self.record["marts_run"])
