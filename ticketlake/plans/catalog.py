"""External tables over a lake, with declared columns and locations, that move without a gap.

    bronze                    partitioned by day and batch
    judged                    all judged rows, partitioned by the run that wrote them, bucket and layer
    silver, quarantine        views of the buckets of `judged` that the visible run has
    <mart>                    a table at the folder of the visible marts

Tables are created once. Registering again adds the partitions of new batches and new buckets, replaces the views and
moves the marts: a reader finds every table at any time, and silver and quarantine each as one run has them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ticketlake.config import BRONZE_SCHEMA, MART_NAMES, MART_SCHEMAS, QUARANTINE_SCHEMA, SILVER_SCHEMA, STAGED_SCHEMA
from ticketlake.plans.lake import Buckets, Lake
from ticketlake.sources import bronze
from ticketlake.sources.bronze import LINEAGE, bronze_path

JUDGED, JUDGED_PARTITIONS = "judged", ("run", "bucket", "layer")
# Partitions that one statement adds.
ADDED_AT_ONCE = 200


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _text(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(spark: SparkSession, table: str, schema: T.StructType, path: str, partitions: Sequence[str] = ()) -> None:
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema)}) USING parquet {by} LOCATION {_text(path)}")


def _known(spark: SparkSession, table: str) -> set[tuple[str, ...]]:
    """Values of the partitions that the catalog has."""
    names = (r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return {tuple(part.split("=", 1)[1] for part in name.split("/")) for name in names}


def _add(spark: SparkSession, table: str, names: Sequence[str], found: Iterable[tuple[str, ...]], folder: str) -> None:
    """Add partitions that the catalog doesn't have, each at its folder."""
    new = sorted(set(found) - _known(spark, table))
    for at in range(0, len(new), ADDED_AT_ONCE):
        parts = []
        for values in new[at : at + ADDED_AT_ONCE]:
            named = list(zip(names, values, strict=True))
            spec = ", ".join(f"`{n}` = {_text(v)}" for n, v in named)
            path = "/".join([folder, *[f"{n}={v}" for n, v in named]])
            parts.append(f"PARTITION ({spec}) LOCATION {_text(path)}")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(parts)}")


def _chosen(buckets: Buckets) -> str:
    """The condition that picks a run's buckets; it names partitions only."""
    by_run: dict[str, list[int]] = {}
    for bucket, version in sorted(buckets.versions.items()):
        by_run.setdefault(version, []).append(bucket)
    picks = [f"(`run` = {_text(run)} AND `bucket` IN ({', '.join(map(str, some))}))" for run, some in by_run.items()]
    return " OR ".join(picks) or "false"


def register(lake: Lake, database: str) -> list[str]:
    """Create or move one table per layer and mart of the published run; returns their names."""
    spark, visible = lake.spark, lake.visible()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    table = f"`{database}`.`bronze`"
    _create(spark, table, BRONZE_SCHEMA, bronze_path(lake.root), LINEAGE)
    listed = bronze.listed(spark, lake.root).select(*LINEAGE).collect()  # a row a batch, as the catalog has partitions
    _add(spark, table, LINEAGE, [(str(r[0]), r[1]) for r in listed], bronze_path(lake.root))

    table, folder = f"`{database}`.`{JUDGED}`", f"{lake.root}/buckets"
    partitions = [T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())]
    _create(spark, table, T.StructType([*STAGED_SCHEMA.fields[:-1], *partitions, STAGED_SCHEMA.fields[-1]]), folder, JUDGED_PARTITIONS)
    layers = [
        (r["version"], str(r["bucket"]), layer)
        for r in visible.buckets.rows
        for layer, rows in (("silver", r["total"] - r["failed"]), ("quarantine", r["failed"]))
        if rows
    ]
    _add(spark, table, JUDGED_PARTITIONS, layers, folder)
    for layer, schema in (("silver", SILVER_SCHEMA), ("quarantine", QUARANTINE_SCHEMA)):
        names = ", ".join(f"`{n}`" for n in schema.fieldNames())
        chosen = f"`layer` = '{layer}' AND ({_chosen(visible.buckets)})"
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{layer}` AS SELECT {names} FROM {table} WHERE {chosen}")

    for name in MART_NAMES:
        table, path = f"`{database}`.`{name}`", lake.gold_path(name, visible.record["marts_run"])
        _create(spark, table, MART_SCHEMAS[name], path)
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(path)}")
        spark.catalog.refreshTable(f"{database}.{name}")
    return ["bronze", "silver", "quarantine", *MART_NAMES]
