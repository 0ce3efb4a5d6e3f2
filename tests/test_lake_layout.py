"""Buckets, the bronze manifest, the compacted log and the catalog."""

from __future__ import annotations

import threading
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import T0, rows_of, ticket
from ticketlake.config import LakeConfig, fresh_dir
from ticketlake.operators import gate, staging
from ticketlake.plans import catalog
from ticketlake.plans.lake import Lake, TwoRecords
from ticketlake.sources import bronze, fs
from ticketlake.sources.log import RecordLog

MANY = LakeConfig(lookback_days=400, buckets=64, threshold=1.0)


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def written(lake, run_id):
    return {int(p.rsplit("=", 1)[1]) for p in fs.glob(lake.spark, f"{lake.buckets_path(run_id)}/bucket=*")}


# ---------------------------------------------------------------- merging by bucket


def test_one_key_in_a_hundred_rewrites_its_buckets_only(spark, lake, run_rows):
    rows = [ticket(i) for i in range(12_800)] + [ticket(None, agency=str(i)) for i in range(20)]
    late = [ticket(i, status="x", agency="LATE", resolution_action_updated_date="2024-06-01T00:00:00.000") for i in range(5_000, 5_128)]
    run_rows(lake, rows, MANY, run_id="one")
    run_rows(lake, late, MANY, run_id="two", merge=True)
    before, after = lake.buckets("one"), lake.buckets("two")
    assert len(before.rows) > 30 and sum(r["total"] for r in before.rows) == 12_820
    touched = {b for b, v in after.versions.items() if v == "two"}
    assert 1 <= len(touched) <= 2 and written(lake, "two") == touched
    assert {b: v for b, v in after.versions.items() if b not in touched} == {b: "one" for b in before.versions if b not in touched}
    rebuilt = Lake(spark, fresh_dir(spark, "lake"))
    run_rows(rebuilt, rows, MANY, run_id="one", at=T0)
    run_rows(rebuilt, late, MANY, run_id="two", at=T0 + timedelta(minutes=1))
    assert same(lake.silver().drop("ingest_date"), rebuilt.silver().drop("ingest_date"))
    assert same(lake.quarantine().drop("ingest_date"), rebuilt.quarantine().drop("ingest_date"))
    assert [r["gold_rows"] for r in (lake.state(), rebuilt.state())] == [lake.state()["gold_rows"]] * 2
    assert lake.state()["rule_failures"] == rebuilt.state()["rule_failures"]
    # buckets of the first run that the second has go with it, the others stay
    lake.expire()
    assert written(lake, "one") == set(before.versions) - touched
    assert lake.silver().count() == 12_800


def test_no_new_rows_write_no_bucket(lake, run_rows):
    rows = [ticket(i) for i in range(300)]
    run_rows(lake, rows, MANY, run_id="one")
    again = run_rows(lake, [], MANY, run_id="two", merge=True)
    assert written(lake, "two") == set() and again["silver_rows"] == 300
    assert lake.silver().count() == 300


def test_rows_without_a_key_of_a_batch_that_comes_again_are_replaced(lake, run_rows):
    rows, day = [ticket(None, agency=str(i)) for i in range(9)] + [ticket(1)], {"ingest_date": T0.date()}
    other = [ticket(None, agency="other")]
    run_rows(lake, rows, MANY, at=T0, **day)
    run_rows(lake, other, MANY, at=T0 + timedelta(hours=1), merge=True, **day)
    run_rows(lake, rows, MANY, run_id="again", at=T0 + timedelta(hours=2), merge=True, **day)
    assert Counter(r[0] for r in lake.quarantine().select("agency").collect()) == Counter([*map(str, range(9)), "OTHER"])
    assert len(written(lake, "again")) <= 2


@pytest.mark.parametrize("change", ["rules", "aliases", "buckets"])
def test_rows_are_judged_anew_when_rules_or_dealing_change(lake, run_rows, change):
    rows = [ticket(i, borough="QUEENS" if i % 2 else "THE QUEENS") for i in range(40)]
    run_rows(lake, rows, MANY, run_id="one")
    cfg, rules = MANY, None
    if change == "rules":
        rules = {"odd": "unique_key % 2 = 1"}
    elif change == "aliases":
        cfg = LakeConfig(lookback_days=400, buckets=64, threshold=1.0, area_aliases={"THE QUEENS": "QUEENS"})
    else:
        cfg = LakeConfig(lookback_days=400, buckets=5, threshold=1.0)
    result = run_rows(lake, [], cfg, run_id="two", merge=True, rules=rules)
    assert set(lake.buckets("two").versions.values()) == {"two"}
    assert result["quarantined"] == {"rules": 20, "aliases": 0, "buckets": 20}[change]
    with pytest.raises(ValueError, match="comma"):
        run_rows(lake, [], cfg, rules={"a,b": "true"})


def test_neighbouring_keys_share_a_bucket_and_others_spread(spark):
    keys = spark.range(256 * 400).select(F.col("id").alias("unique_key"), F.lit(T0.date()).alias("ingest_date"), F.lit("b").alias("_batch_id"))
    dealt = keys.select(F.floor(F.col("unique_key") / 256).alias("run"), staging.bucket_of(20).alias("bucket")).distinct().collect()
    assert len(dealt) == 400 and min(Counter(r["bucket"] for r in dealt).values()) >= 5


# ---------------------------------------------------------------- manifest


def test_the_manifest_lists_what_bronze_holds(spark):
    root = fresh_dir(spark, "bronze")
    frame = lambda rows: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in bronze.RAW_COLUMNS))

    def ingest(rows, hours, day=date(2024, 3, 5)):
        return bronze.ingest(frame(rows), root, ingest_date=day, ingested_at=T0 + timedelta(hours=hours), source="t")

    first = ingest([ticket(3), ticket(9), ticket(None)], 0)
    ingest([ticket(None)], 1)
    ingest([ticket(3), ticket(9), ticket(None)], 2)  # the first again, later
    ingest([ticket(5)], 1, date(2024, 3, 6))
    listed = bronze.listed(spark, root)
    assert rows_of(listed, "ingest_date", "_batch_id", "_ingested_at") == rows_of(bronze.batches(bronze.scan(spark, root)), "ingest_date", "_batch_id", "_ingested_at")
    mine = listed.filter(F.col("_batch_id") == first.batch_id).first()
    assert (mine["rows"], mine["low_key"], mine["high_key"], mine["_ingested_at"]) == (3, 3, 9, T0 + timedelta(hours=2))
    assert rows_of(listed.filter("low_key is null"), "rows") == [(1,)]
    files = listed.inputFiles()
    assert files and all("/manifest" in f for f in files)  # no bronze row is read


def test_a_batch_whose_writer_stopped_is_looked_up_in_its_partition(spark):
    root = fresh_dir(spark, "bronze")
    frame = lambda rows: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in bronze.RAW_COLUMNS))
    day = date(2024, 3, 5)
    kept = bronze.ingest(frame([ticket(3)]), root, ingest_date=day, ingested_at=T0, source="t")
    log = bronze.manifest(spark, root)
    # it came again and was being replaced; another one never got to its rows
    log.append(log.newest()[0] + 1, {"ingest_date": day, "_batch_id": kept.batch_id, "stored": False})
    log.append(log.newest()[0] + 1, {"ingest_date": day, "_batch_id": "b0", "stored": False})
    assert rows_of(bronze.listed(spark, root), "_batch_id", "_ingested_at", "rows", "low_key") == [(kept.batch_id, T0, 1, 3)]
    assert log.rows().filter("not stored").isEmpty()


# ---------------------------------------------------------------- log


LOG = T.StructType([T.StructField("seq", T.LongType()), T.StructField("k", T.StringType()), T.StructField("at", T.TimestampNTZType())])


@pytest.mark.parametrize("key", [(), ("k",)])
def test_files_opened_do_not_grow_with_the_log(spark, key):
    log, moment = RecordLog(spark, fresh_dir(spark, "log"), LOG, key, every=4), datetime(2024, 5, 1, 1, 2, 3, 4)
    for n in range(1, 31):
        made = log.append(log.newest()[0] + 1, {"k": str(n % 3), "at": moment})
        assert (made["seq"], log.record(log.newest()[1][0])) == (n, made)
        assert len(log.entries()) <= 8 and len(log.compacted()) <= 2
    want = [(n, str(n % 3), moment) for n in (range(28, 31) if key else range(1, 31))]
    assert rows_of(log.rows(), "seq", "k", "at") == want
    assert len(log.rows().inputFiles()) <= 5


def test_two_writers_of_one_number_are_noticed_also_when_the_log_is_due(spark, lake):
    lake.log.every = 3
    before = None
    for n in range(1, 6):
        before = lake.state()
        lake.record(before, run_id=f"r{n}")
    lake.record(before, run_id="at the same time")
    with pytest.raises(TwoRecords):
        lake.state()
    with pytest.raises(ValueError, match="taken"):
        other = Lake(spark, fresh_dir(spark, "lake"))
        for n in range(40):
            other.record(other.state(), run_id=f"r{n}")
        other.state(new_run="r2")


# ---------------------------------------------------------------- catalog


def test_a_reader_beside_register_misses_no_table_and_sees_one_run_at_a_time(spark, lake, run_rows):
    run_rows(lake, [ticket(i) for i in range(600)], MANY, run_id="one")
    names = catalog.register(lake, "beside")
    sizes, seen, failures, done = [600], [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(spark.table("beside.silver").count())
                for name in names:
                    spark.table(f"beside.{name}").limit(1).collect()
            except Exception as error:  # the test reports it
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for i in range(1, 3):
            run_rows(lake, [ticket(i * 1000 + n) for n in range(300)], MANY, run_id=f"more-{i}", merge=True)
            assert catalog.register(lake, "beside") == names
            sizes.append(sizes[-1] + 300)
    finally:
        done.set()
        reader.join()
    assert not failures and set(seen) <= set(sizes)
    assert spark.table("beside.silver").count() == sizes[-1] == lake.silver().count()
    assert spark.table("beside.bronze").count() == 1200
    assert same(spark.table("beside.silver"), lake.silver())
    assert spark.table("beside.sla_breach_rate").agg(F.sum("tickets")).first()[0] == 1200
    assert set(gate.default_rules(MANY))
