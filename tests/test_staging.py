from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0, lasting, rows_of, ticket
from ticketlake.config import SILVER_SCHEMA, LakeConfig, fresh_dir
from ticketlake.operators import staging
from ticketlake.operators.versions import latest_keyed, newer
from ticketlake.sources import bronze
from ticketlake.sources.bronze import STORED_ROW_ID

CFG = LakeConfig()
LATER = T0 + timedelta(days=1)


def test_schema_is_the_declared_one(stage):
    got = [(f.name, f.dataType) for f in stage([ticket(1)]).schema.fields]
    assert got == [(f.name, f.dataType) for f in SILVER_SCHEMA.fields]


@pytest.mark.parametrize("reverse", [False, True])
def test_latest_version_wins_in_any_arrival_order(bronze_of, reverse):
    first, second = [ticket(1)], [lasting(1, 31.5, start=datetime(2024, 3, 11, 8, 30))]
    order = [second, first] if reverse else [first, second]
    out = staging.staged(bronze_of((order[0], T0), (order[1], LATER)), CFG)
    assert rows_of(out, "unique_key", "status", "response_hours") == [(1, "Closed", 31.5)]


def test_equal_update_times_keep_the_later_ingest(bronze_of):
    out = staging.staged(
        bronze_of(([ticket(1, agency="A")], LATER), ([ticket(1, agency="B")], T0)), CFG
    )
    assert rows_of(out, "agency") == [("A",)]


def test_a_missing_update_time_is_the_oldest(bronze_of):
    unknown = list(ticket(1, agency="OLD"))
    unknown[3] = "not a date"
    out = staging.staged(bronze_of(([ticket(1)], T0), ([tuple(unknown)], LATER)), CFG)
    assert rows_of(out, "agency") == [("PARKS",)]


def test_rows_without_a_usable_key_are_all_kept(stage):
    out = stage([ticket(None), ticket(None), ticket("abc"), ticket("abc"), ticket(5), ticket(5)])
    assert out.filter(F.col("unique_key").isNull()).count() == 4
    assert out.count() == 5


def test_standardisation(stage):
    out = stage(
        [ticket(1, agency=" parks\t", complaint_type=" Fallen  Tree ", incident_zip=" 10314-0007",
                borough="staten is ", latitude="north", longitude=None)]
    )
    columns = ("agency", "complaint_type", "incident_zip", "borough", "latitude", "longitude")
    assert [tuple(r) for r in out.select(*columns).collect()] == [
        ("PARKS\t", "Fallen  Tree", "10314", "STATEN ISLAND", None, None)
    ]


def test_open_requests_have_no_hours_and_early_closure_is_negative(stage):
    out = stage([ticket(1), lasting(2, -7.25), lasting(3, 0.5)])
    got = {r["unique_key"]: r["response_hours"] for r in out.collect()}
    assert got == {1: None, 2: -7.25, 3: 0.5}


def _versions(n, seed=3):
    """Random versions of few keys, among them a key with a third of the rows, and unkeyed rows."""
    rng = random.Random(seed)
    for _ in range(n):
        hot = rng.random() < 0.34
        key = 1 if hot else rng.choice([None, "abc", *range(2, 40)])
        day = datetime(2024, 3, 1) + timedelta(hours=rng.randrange(200))
        yield lasting(key, rng.randrange(1, 9), start=day, agency=rng.choice("ABC"))


def brute_force(rows):
    """Newest version per key among (typed values, ingest time, batch)."""
    best, unkeyed = {}, []
    for row, at, batch in rows:
        if row[0] is None or not row[0].isdigit():
            unkeyed.append(row)
            continue
        order = (row[3], at, batch, row[1], row[2], row[4])
        if row[0] not in best or order > best[row[0]][0]:
            best[row[0]] = (order, row)
    return [r for _, r in best.values()], unkeyed


def test_both_forms_equal_brute_force_with_a_hot_key(spark, bronze_of):
    batches = [(list(_versions(300, seed)), T0 + timedelta(hours=seed)) for seed in (1, 2, 3)]
    table = bronze_of(*batches)
    path = fresh_dir(spark, "versions")
    table.repartition(7).write.parquet(path)
    ids = [F.col(f"_metadata.{m}").alias(n) for n, m in STORED_ROW_ID.items()]
    with_ids = spark.read.parquet(path).select("*", *ids)
    kept, unkeyed = brute_force(
        [(r, at, f"b{i}") for i, (rows, at) in enumerate(batches) for r in rows]
    )
    want = sorted((int(r[0]), r[4]) for r in kept)
    for out in (
        staging.staged(table.repartition(5), CFG),
        staging.staged(with_ids, CFG, row_id=tuple(STORED_ROW_ID)),
    ):
        keyed = out.filter(F.col("unique_key").isNotNull())
        assert rows_of(keyed, "unique_key", "agency") == want
        assert out.count() - keyed.count() == len(unkeyed)


def test_versions_are_cut_before_the_shuffle(spark, bronze_of):
    out = staging.staged(bronze_of((list(_versions(50)), T0)), CFG)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial before the exchange, final after it


def test_merge_equals_rebuild(spark, raw):
    """Folding in batches one by one, one of them read again, equals staging all of bronze."""
    root = fresh_dir(spark, "merge")
    extra = ("_ingested_at", "_batch_id")
    staged = None
    deliveries = [list(_versions(120, seed)) for seed in (4, 5, 6)]
    for i, rows in enumerate([*deliveries, deliveries[1]]):
        at = T0 + timedelta(hours=i)
        batch = bronze.ingest(
            raw(rows), root, ingest_date=T0.date(), ingested_at=at, source="test"
        )
        everything = bronze.scan(spark, root)
        new = everything.filter(F.col("_batch_id") == batch.batch_id)
        pairs = new.select("ingest_date", "_batch_id").distinct()
        typed = staging.typed(new, CFG)
        if staged is None:
            merged = staging.with_response_hours(staging.newest_rows(typed), extra)
        else:
            merged = staging.merge_staged(staged, typed, pairs, extra)
        path = fresh_dir(spark, "merged")
        merged.write.parquet(path)
        staged = spark.read.parquet(path)
    rebuilt = staging.staged(bronze.scan(spark, root), CFG, extra=extra)
    assert staged.exceptAll(rebuilt).count() == 0
    assert rebuilt.exceptAll(staged).count() == 0


def test_a_merge_of_many_keys_shuffles_the_earlier_rows_once_for_both_joins(spark, bronze_of, tmp_path):
    cfg = LakeConfig()
    before = [*map(ticket, range(300)), ticket(None)]
    bronze_of((before, T0)).write.parquet(f"{tmp_path}/first")
    bronze_of((before[:150], T0 + timedelta(days=1))).write.parquet(f"{tmp_path}/late")
    extra = ("_ingested_at", "_batch_id")
    staging.staged(spark.read.parquet(f"{tmp_path}/first"), cfg, extra=extra).write.parquet(f"{tmp_path}/staged")
    new = staging.typed(spark.read.parquet(f"{tmp_path}/late"), cfg)
    batches = new.select("ingest_date", "_batch_id").distinct()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = staging.merge_staged(spark.read.parquet(f"{tmp_path}/staged"), new, batches, extra)
        assert len(merged.collect()) == 301
        plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("ReusedExchange") >= 2, plan  # the keys that arrived, and the earlier rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_of_rows_that_meet_in_a_merge_the_higher_stays_with_null_lowest(spark):
    schema = "k bigint, a int, b string, more string"
    left = spark.createDataFrame([(1, None, "x", "l"), (2, 5, "x", "l"), (3, 5, "y", "l"), (4, 1, "x", "l"), (None, 9, "x", "l")], schema)
    right = spark.createDataFrame([(1, 3, None, "r"), (2, None, "z", "r"), (3, 5, None, "r"), (5, 1, "x", "r"), (None, 8, "x", "r")], schema)
    assert rows_of(newer(left, right, "k", ("a", "b")), "k", "more") == [(1, "r"), (2, "l"), (3, "l")]
    assert rows_of(newer(right, left, "k", ("a", "b")), "k", "more") == [(1, "r"), (2, "l"), (3, "l")]
    both = latest_keyed(left.unionByName(right), "k", ("a", "b"))
    assert rows_of(both, "k", "more") == [(1, "r"), (2, "l"), (3, "l"), (4, "l"), (5, "r")]


def test_rows_that_meet_in_a_merge_are_not_shuffled_again(spark, bronze_of):
    cfg, extra = LakeConfig(), ("_ingested_at", "_batch_id")
    previous = staging.staged(bronze_of((map(ticket, range(20)), T0)), cfg, extra=extra)
    new = staging.typed(bronze_of((map(ticket, range(9, 30)), T0 + timedelta(days=1))), cfg)
    merged = staging.merge_staged(previous, new, new.select("ingest_date", "_batch_id").distinct(), extra)
    assert merged.select("unique_key").distinct().count() == merged.count() == 30
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1
