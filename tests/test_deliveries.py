"""What queries that deliver raw rows read, shuffle and leave on disk, over small tables of their own."""

from __future__ import annotations

import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import queries
from ticketlake.config import LakeConfig, fresh_dir, made_dirs, shuffles_freed
from ticketlake.operators import gate
from ticketlake.sources import bronze
from ticketlake.sources.tables import raw_requests

from tests.conftest import T0, ticket

ORDERS, PARTS = 60, 7


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Four line items an order, of different parts; a customer in three has a postcode that is missing."""
    day = datetime(1997, 5, 1)
    tables = {
        "region": [("r_regionkey int, r_name string"), [(0, "ASIA"), (1, "MIDDLE EAST")]],
        "nation": [("n_nationkey int, n_regionkey int"), [(0, 0), (1, 1)]],
        "customer": [("c_custkey bigint, c_nationkey int"), [(k, k % 2) for k in range(49, 55)]],
        "part": [("p_partkey bigint, p_name string, p_brand string"), [(k, f"part {k}", f"brand {k % 3}") for k in range(1, PARTS + 1)]],
        "orders": [
            "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
            [(k, 49 + k % 6, day, "1-URGENT") for k in range(10, 10 + ORDERS)],
        ],
        "lineitem": [
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_linestatus string, l_shipdate timestamp_ntz",
            [(k, 1 + (k + line) % PARTS, 1, line, 3.5 * line, "FO"[line % 2], day) for line in range(1, 5) for k in range(10, 10 + ORDERS)],
        ],
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def written(label):
    """The folders that queries have made under a name since the last call."""
    return [Path(p) for p in made_dirs() if Path(p).name.startswith(f"{label}-")]


@pytest.fixture
def delivered(monkeypatch):
    """Which files each delivery to bronze is read from."""
    seen, ingest = [], bronze.ingest

    def noting(rows, *args, **more):
        seen.append(rows.inputFiles())
        return ingest(rows, *args, **more)

    monkeypatch.setattr(bronze, "ingest", noting)
    return seen


def test_landed_lines_are_compressed_and_come_back_whole(spark, sf_dir):
    made_dirs()
    got = queries.QUERIES["landing_jsonl_roundtrip"](spark, sf_dir)
    (folder,) = written("jsonl")
    files = [f.name for f in folder.iterdir() if f.name.startswith("part-")]
    assert files and all(f.endswith(".json.lz4") for f in files)
    raw = raw_requests(spark, sf_dir).select(*got.columns)
    assert got.count() == 4 * ORDERS and raw.exceptAll(got).isEmpty()


def test_the_lines_of_an_order_leave_one_task(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # all tables too large to broadcast
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = raw_requests(spark, sf_dir).withColumn("task", F.spark_partition_id())
        tasks = rows.groupBy("created_date", "unique_key").agg(F.countDistinct("task").alias("tasks"), F.count(F.lit(1)).alias("lines"))
        assert {(r["tasks"], r["lines"]) for r in tasks.collect()} == {(1, 4)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def test_a_delivery_leaves_no_shuffle_files(spark, raw):
    root, rows = fresh_dir(spark, "bronze"), raw([ticket(i) for i in range(200)])
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name, None)
    batch = bronze.ingest(rows.repartition(3, "unique_key"), root, ingest_date=T0.date(), ingested_at=T0, source="test")
    for _ in range(50):  # files are removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert batch.rows == 200 and not left
    assert spark.conf.get(name, None) == setting
    with pytest.raises(ZeroDivisionError), shuffles_freed(spark):
        raise ZeroDivisionError
    assert spark.conf.get(name, None) == setting


def test_rows_that_come_again_are_joined_once(spark, sf_dir, delivered):
    row = queries.QUERIES["bronze_reingest_idempotent"](spark, sf_dir).first()
    assert tuple(row) == (4 * ORDERS, 1, datetime(2024, 2, 1, 6), True)
    assert len(delivered) == 2 and not any("lineitem" in file for files in delivered for file in files)


def test_a_replay_joins_its_rows_once(spark, sf_dir, delivered):
    rows = queries.QUERIES["stream_replay"](spark, sf_dir)
    assert rows.count() == 4 * ORDERS and {r["_ingested_at"] for r in rows.collect()} == {datetime(2024, 2, 1)}
    assert len(delivered) == 2 and not any("lineitem" in file for files in delivered for file in files)


def test_verdicts_are_added_behind_the_shuffle_to_buckets(lake, run_rows, monkeypatch):
    plans, verdict = [], gate.verdict

    def noting(rows, rules):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return verdict(rows, rules)

    monkeypatch.setattr(gate, "verdict", noting)
    run_rows(lake, [ticket(1), ticket(2, borough="nowhere"), ticket(3, closed_date="2024-03-11T10:30:00.000")], LakeConfig(threshold=1))
    (plan,) = plans
    assert "response_hours" in plan.partition("RebalancePartitions")[0] and "RebalancePartitions" in plan
    assert "response_hours" not in plan.partition("RebalancePartitions")[2]
    assert lake.silver().filter("unique_key = 3").first()["response_hours"] == 2.0
    assert [r["failed_rules"] for r in lake.quarantine().collect()] == ["valid_borough"]


def test_a_forced_run_joins_nothing_again(spark, sf_dir, delivered):
    log = {r["seq"]: r for r in queries.QUERIES["rerun_idempotent"](spark, sf_dir).collect()}
    assert [log[n]["fetched"] for n in (1, 2, 3)] == [4 * ORDERS, 0, 4 * ORDERS]
    assert {(r["bronze_rows"], r["batches"], r["lost"], r["added"]) for r in log.values()} == {(4 * ORDERS, 1, 0, 0)}
    assert len(delivered) == 3 and not any("lineitem" in file for files in delivered for file in files)


def test_lost_and_added_rows_are_counted_as_except_all_counts_them(spark):
    schema = "a int, b string, c double"
    same = [(1, "x", 0.5), (None, None, None), (None, None, None), (2, None, float("nan"))]
    before = spark.createDataFrame([*same, (3, "only", 1.0), (3, "only", 1.0), (4, "less", 0.0), (4, "less", 0.0)], schema)
    after = spark.createDataFrame([*same, (None, None, None), (4, "less", -0.0), (5, "new", None)], schema)
    found = queries.lost_and_added(before, after)
    assert tuple(found.first()) == (before.exceptAll(after).count(), after.exceptAll(before).count()) == (3, 2)
    assert tuple(queries.lost_and_added(before.limit(0), after.limit(0)).first()) == (0, 0)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1
