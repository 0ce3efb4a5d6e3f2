"""Fixed schemas, engine parameters and the session settings the lake expects."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The raw record's columns, in source order.
RAW_COLUMNS = (
    "unique_key",
    "created_date",
    "closed_date",
    "resolution_action_updated_date",
    "agency",
    "complaint_type",
    "descriptor",
    "status",
    "incident_zip",
    "borough",
    "latitude",
    "longitude",
)

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

BRONZE_SCHEMA = T.StructType(
    [
        *RAW_SCHEMA.fields,
        T.StructField("_source", T.StringType()),
        T.StructField("_ingested_at", T.TimestampNTZType()),
        T.StructField("ingest_date", T.DateType()),
        T.StructField("_batch_id", T.StringType()),
    ]
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("unique_key", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("closed_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("agency", T.StringType()),
        T.StructField("complaint_type", T.StringType()),
        T.StructField("descriptor", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("incident_zip", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("response_hours", T.DoubleType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)
SILVER_COLUMNS = tuple(SILVER_SCHEMA.fieldNames())

QUARANTINE_SCHEMA = T.StructType(
    [*SILVER_SCHEMA.fields, T.StructField("failed_rules", T.StringType())]
)

# What one run writes: silver columns, the verdict, and the lineage that orders versions.
STAGED_SCHEMA = T.StructType(
    [
        *QUARANTINE_SCHEMA.fields,
        T.StructField("_ingested_at", T.TimestampNTZType()),
        T.StructField("_batch_id", T.StringType()),
        T.StructField("layer", T.StringType()),
    ]
)

# The buckets of one run's staging: the run that wrote each, and what the gate counted in it. `judged_by` tells rules
# and standardisation apart.
BUCKET_SCHEMA = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("version", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("failed", T.LongType()),
        T.StructField("rules", T.MapType(T.StringType(), T.LongType())),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("judged_by", T.StringType()),
    ]
)

MART_SCHEMAS = {
    "response_time_by_borough_month": T.StructType(
        [
            T.StructField("month", T.DateType()),
            T.StructField("borough", T.StringType()),
            T.StructField("closed_tickets", T.LongType()),
            T.StructField("median_response_hours", T.DoubleType()),
            T.StructField("p90_response_hours", T.DoubleType()),
            T.StructField("mean_response_hours", T.DoubleType()),
        ]
    ),
    "top_complaints_by_zip": T.StructType(
        [
            T.StructField("incident_zip", T.StringType()),
            T.StructField("rank", T.LongType()),
            T.StructField("complaint_type", T.StringType()),
            T.StructField("tickets", T.LongType()),
            T.StructField("share_of_zip", T.DoubleType()),
        ]
    ),
    "sla_breach_rate": T.StructType(
        [
            T.StructField("agency", T.StringType()),
            T.StructField("month", T.DateType()),
            T.StructField("tickets", T.LongType()),
            T.StructField("breached_tickets", T.LongType()),
            T.StructField("breach_rate", T.DoubleType()),
            T.StructField("sla_hours", T.IntegerType()),
        ]
    ),
}
MART_NAMES = tuple(MART_SCHEMAS)

# The areas a published row may carry, and the one spelling that is repaired.
AREAS = ("BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND")
AREA_ALIASES = {"STATEN IS": "STATEN ISLAND"}


@dataclass(frozen=True)
class Box:
    """Inclusive coordinate bounds (fixed values by default)."""

    lat_min: float = 40.45
    lat_max: float = 40.95
    lon_min: float = -74.30
    lon_max: float = -73.65


@dataclass(frozen=True)
class LakeConfig:
    """Every parameter of a run, checked when built. `max_rows` caps a limit that a caller gives; no limit reads
    the whole window."""

    areas: tuple[str, ...] = AREAS
    area_aliases: Mapping[str, str] = field(default_factory=lambda: dict(AREA_ALIASES))
    box: Box = Box()
    threshold: float = 0.05
    sla_hours: int = 72
    lookback_days: int = 0
    max_rows: int = 50_000
    page_size: int = 10_000
    # staging is stored in that many buckets of keys; a merge rewrites those that new rows fall into
    buckets: int = 16

    def __post_init__(self) -> None:
        if not 0 <= self.threshold <= 1:
            raise ValueError(f"threshold must lie in 0..1, got {self.threshold}")
        if self.sla_hours < 1:
            raise ValueError(f"sla_hours must be at least 1, got {self.sla_hours}")
        if self.lookback_days < 0:
            raise ValueError(f"lookback_days must not be negative, got {self.lookback_days}")
        if self.max_rows < 1 or self.page_size < 1 or self.buckets < 1:
            raise ValueError("max_rows, page_size and buckets must be at least 1")

    def check_limit(self, limit: int | None) -> None:
        """A source is asked for 1..max_rows rows; None means the whole window."""
        if limit is not None and not 1 <= limit <= self.max_rows:
            raise ValueError(f"limit {limit} is outside 1..{self.max_rows}")


# Settings for a session that owns the lake. Write options that results depend on are also
# given at each write, so a session without these still produces the same tables.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # a first-n cut larger than this is sorted by ranges before one task takes its head, instead of being
    # held in a heap; the rows are the same
    "spark.sql.execution.topKSortFallbackThreshold": "200000",
    # a task keeps both layers' files open instead of sorting its rows by layer
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # bounds on the creation time reach a paged service
    "spark.sql.python.filterPushdown.enabled": "true",
}
PARTITION_BYTES = 128 << 20


def settings_for(input_bytes: int) -> dict[str, str]:
    """SESSION_SETTINGS for an input of this size: shuffles start with partitions of PARTITION_BYTES, which AQE
    then joins where they turn out small; it doesn't split ones that are too large."""
    partitions = max(8, -(-input_bytes // PARTITION_BYTES))
    return {**SESSION_SETTINGS, "spark.sql.shuffle.partitions": str(partitions)}


def is_local(spark: SparkSession) -> bool:
    """One JVM on this machine; `local-cluster` has executors of its own and counts as a cluster."""
    return spark.sparkContext.master.partition("[")[0] == "local"


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary folder only in local mode without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="ticketlake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes that run meanwhile give back the files of their shuffles when they end; otherwise these stay on the
    executors' disks until the driver happens to collect its garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


_made: list[str] = []


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder's name under the shared folder; `made_dirs` lists the names given out."""
    _made.append(f"{shared_root(spark)}/ticketlake/{label}-{uuid.uuid4().hex}")
    return _made[-1]


def made_dirs() -> list[str]:
    """Names that this process took since the last call, for whoever cleans up after its queries."""
    names = list(_made)
    _made.clear()
    return names
