"""The registered queries: every operator of the lake run over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.config import MART_NAMES, RAW_COLUMNS, LakeConfig, fresh_dir, shuffles_freed
from ticketlake.functions.casts import ntz
from ticketlake.functions.numeric import seconds_between
from ticketlake.functions.text import category, postcode
from ticketlake.operators import extract, gate, marts, staging
from ticketlake.operators.fingerprint import fingerprint
from ticketlake.operators.versions import latest_versions
from ticketlake.plans import catalog, report
from ticketlake.plans.lake import Lake
from ticketlake.plans.run import frame_fetcher, rebuild_marts, run
from ticketlake.sources import bronze
from ticketlake.sources.bronze import STORED_ROW_ID
from ticketlake.sources.files import LANDING_CODEC, output, read_csv, read_jsonl, write_jsonl
from ticketlake.sources.tables import ORDER_LAKE, raw_only, raw_requests
from ticketlake.streaming.landing import epoch_time, ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

CFG = ORDER_LAKE
ROW_ID = tuple(STORED_ROW_ID)
EPOCH = datetime(1990, 1, 1)
DAY_1, DAY_2, DAY_3 = datetime(2024, 2, 1), datetime(2024, 2, 2), datetime(2024, 2, 3)
SINCE, UNTIL = "1996-01-01T00:00:00.000", "1999-06-30T12:00:00.000"
VERSION_KEYS = ("unique_key", "_ingested_at", "_batch_id")


# ---------------------------------------------------------------- shared steps


def rules() -> dict:
    return gate.default_rules(CFG)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staged(raw_requests(spark, sf_dir), CFG, ROW_ID)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.verdict(staged(spark, sf_dir), rules())


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.good(judged(spark, sf_dir))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table that has several readers to the shared folder, as a run does with staging."""
    path = fresh_dir(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def stored_raw(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """The raw rows of queries that deliver them more than once."""
    return stored(raw_requests(spark, sf_dir).select(*RAW_COLUMNS, *more), "raw")


def stored_silver(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Silver, or the columns of it that the readers use."""
    return stored(silver(spark, sf_dir).select(*columns or ["*"]), "silver")


def stored_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    built = marts.build_marts(stored_silver(spark, sf_dir), CFG)
    return {n: stored(m, n) for n, m in built.items()}


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, fresh_dir(spark, "lake"))


def run_lake(
    lake: Lake, rows: DataFrame, run_id: str, at: datetime, cfg: LakeConfig = CFG, **more
):
    fetch = frame_fetcher(lambda _: rows, cfg)
    more = {"since": EPOCH, "source": "orders", **more}
    return run(lake, fetch, run_id=run_id, ingested_at=at, cfg=cfg, **more)


def early_and_late(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two deliveries: the first three versions of every request, then the others."""
    raw = raw_requests(spark, sf_dir)
    return raw.filter("line <= 3"), raw.filter("line > 3")


def lost_and_added(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: how many rows only the first table has, and how many only the second, copies counted as `exceptAll`
    counts them; the rows are shuffled once for both."""
    both = before.withColumn("_more", F.lit(1)).unionByName(after.withColumn("_more", F.lit(-1)))
    more = F.col("_more")
    return both.groupBy(*before.columns).agg(F.sum("_more").alias("_more")).agg(
        F.coalesce(F.sum(F.greatest(more, F.lit(0))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.greatest(-more, F.lit(0))), F.lit(0)).alias("added"),
    )


def key_text(df: DataFrame) -> DataFrame:
    """Results that hold rows without a key give it as text, so data frames keep it exact, and its type beside it."""
    key = F.col("unique_key")
    return df.withColumns({"key_type": F.typeof(key), "unique_key": key.cast("string")})


# ---------------------------------------------------------------- staging


def typed(spark, sf_dir):
    return staging.typed(raw_requests(spark, sf_dir), CFG)


def stage_typed(spark, sf_dir):
    return key_text(typed(spark, sf_dir))


def silver_staged(spark, sf_dir):
    return key_text(staged(spark, sf_dir))


def zip_normalise(spark, sf_dir):
    return raw_requests(spark, sf_dir).select(
        *VERSION_KEYS,
        F.col("incident_zip").alias("zip_text"),
        postcode(F.col("incident_zip")).alias("zip"),
    )


def category_normalise(spark, sf_dir):
    return raw_requests(spark, sf_dir).select(
        *VERSION_KEYS,
        F.col("borough").alias("area_text"),
        category(F.col("borough"), CFG.area_aliases).alias("area"),
    )


def elapsed_hours(spark, sf_dir):
    return stage_typed(spark, sf_dir).select(
        *VERSION_KEYS,
        seconds_between(F.col("created_at"), F.col("closed_at")).cast("string").alias("seconds"),
        staging.response_hours(F.col("created_at"), F.col("closed_at")).alias("response_hours"),
    )


def dedup_latest(spark, sf_dir):
    """The general form, for rows that bring no stored row ids."""
    rows = typed(spark, sf_dir)
    kept = latest_versions(rows, "unique_key", staging.VERSION_ORDER, staging.TIE_BREAK)
    return key_text(kept).select("unique_key", "key_type", "updated_at", "_ingested_at", "_batch_id", "status")


def stage_incremental(spark, sf_dir):
    early, late = early_and_late(spark, sf_dir)
    before = staging.staged(early, CFG, ROW_ID, extra=("_ingested_at", "_batch_id"))
    new = staging.typed(late, CFG)
    batches = new.select("ingest_date", "_batch_id").distinct()
    return key_text(staging.merge_staged(stored(before, "staged"), new, batches))


# ---------------------------------------------------------------- extract


def extract_window(spark, sf_dir):
    return extract.extract(raw_requests(spark, sf_dir), CFG, SINCE, None, UNTIL)


def extract_first_n(spark, sf_dir):
    return extract.extract(raw_requests(spark, sf_dir), CFG, SINCE, 1000, UNTIL)


def extract_page(spark, sf_dir):
    return extract.page(raw_only(raw_requests(spark, sf_dir)), 1500, 500)


def newest_created(spark, sf_dir):
    return raw_requests(spark, sf_dir).agg(extract.newest_created().alias("newest"))


def effective_since(spark, sf_dir):
    """Where the next run would start, per lookback, from the newest request of each area."""
    since = ntz("1996-01-01")
    newest = (
        raw_requests(spark, sf_dir)
        .groupBy(category(F.col("borough"), CFG.area_aliases).alias("area"))
        .agg(extract.newest_created().alias("watermark"))
    )
    looked = newest.withColumn("lookback_days", F.explode(F.array(*map(F.lit, (0, 7, 2500)))))
    start = extract.effective_since(F.col("watermark"), since, F.col("lookback_days"))
    fresh = extract.effective_since(ntz(None), since, F.col("lookback_days"))
    return looked.select(
        "area", "lookback_days", start.alias("start"), fresh.alias("start_without_state")
    )


def watermark_advance(spark, sf_dir):
    """Watermark per area after a first delivery, then after a second that may hold older rows."""
    raw = raw_requests(spark, sf_dir)
    area = category(F.col("borough"), CFG.area_aliases).alias("area")
    created = extract.created_at()
    seen = raw.groupBy(area).agg(
        F.max(F.when(F.col("line") <= 3, created)).alias("old"),
        F.max(F.when(F.col("line") > 3, created)).alias("seen"),
    )
    return seen.withColumn("watermark", extract.advance(F.col("old"), F.col("seen")))


# ---------------------------------------------------------------- gate


def _violations(name: str) -> Query:
    def query(spark, sf_dir):
        return key_text(staged(spark, sf_dir).filter(rules()[name]))

    return query


def gate_tags(spark, sf_dir):
    tagged = gate.tag(staged(spark, sf_dir), rules(), "failed")
    return key_text(tagged).select(
        "unique_key",
        "key_type",
        "created_at",
        "updated_at",
        F.size("failed").alias("n_failed"),
        F.array_join("failed", ",").alias("failed"),
    )


def gate_report(spark, sf_dir):
    return gate.gate_report(staged(spark, sf_dir), rules(), CFG.threshold)


def quarantine(spark, sf_dir):
    return key_text(gate.quarantined(judged(spark, sf_dir)))


def gate_partition_invariant(spark, sf_dir):
    """Good and quarantined rows together are the staged rows, neither more nor fewer."""
    everything = stored(judged(spark, sf_dir), "judged")
    rows = everything.drop("failed_rules")
    parts = gate.good(everything).unionByName(gate.quarantined(everything).drop("failed_rules"))
    sizes = everything.agg(
        F.count(F.lit(1)).alias("staged"),
        F.count_if(F.col("failed_rules").isNull()).alias("good"),
        F.count_if(F.col("failed_rules").isNotNull()).alias("quarantined"),
    )
    lost = rows.exceptAll(parts).agg(F.count(F.lit(1)).alias("lost"))
    added = parts.exceptAll(rows).agg(F.count(F.lit(1)).alias("added"))
    return sizes.crossJoin(lost).crossJoin(added)


# ---------------------------------------------------------------- marts


def gold_response_time(spark, sf_dir):
    return marts.response_time(silver(spark, sf_dir))


def complaint_counts(spark, sf_dir):
    return marts.complaint_counts(silver(spark, sf_dir))


def gold_top_complaints(spark, sf_dir):
    return marts.top_complaints(silver(spark, sf_dir))


SLA_COLUMNS = ("unique_key", "agency", "created_at", "closed_at", "response_hours")


def sla_flagged(spark, sf_dir):
    return marts.sla_flagged(stored_silver(spark, sf_dir, *SLA_COLUMNS), 72)


def gold_sla_breach_72(spark, sf_dir):
    return marts.sla_breach(stored_silver(spark, sf_dir, *SLA_COLUMNS), 72)


def gold_sla_breach_24(spark, sf_dir):
    return marts.sla_breach(stored_silver(spark, sf_dir, *SLA_COLUMNS), 24)


def gold_row_counts(spark, sf_dir):
    return report.gold_row_counts(stored_marts(spark, sf_dir))


# ---------------------------------------------------------------- sources and bronze


def _window_pages(spark, sf_dir, since=SINCE, until=UNTIL, limit=None):
    """The window's rows by number, as a paged service hands them out; the first `limit` of them."""
    numbered = extract.numbered(extract.in_window(raw_requests(spark, sf_dir), since, until), ROW_ID)
    return numbered if limit is None else numbered.filter(F.col("position") < limit)


def src_paged_window(spark, sf_dir):
    """The whole window from its numbered rows."""
    return _window_pages(spark, sf_dir).filter(F.col("position") >= 0).select(*RAW_COLUMNS)


def paged_run(spark, sf_dir):
    """A lake run whose source hands out numbered rows of a window, read to its end without a limit."""
    lake, until = new_lake(spark), datetime.fromisoformat(UNTIL)

    def fetch(spark, since, until, limit):
        return _window_pages(spark, sf_dir, since, until, limit).select(*RAW_COLUMNS)

    since = datetime.fromisoformat(SINCE)
    run(lake, fetch, source="pages", since=since, until=until, run_id="only", ingested_at=DAY_1, cfg=CFG)
    return lake.silver()


def csv_run(spark, sf_dir):
    """A lake run over CSV files whose headers differ in order; one of them lacks columns that are empty."""
    lake, root = new_lake(spark), fresh_dir(spark, "csv")
    raw = stored(raw_requests(spark, sf_dir).select(*RAW_COLUMNS, "line"), "raw")
    plain = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    still_open = F.col("closed_date").isNull()
    parts = {
        "a": raw.filter(~still_open & (F.col("line") <= 3)).select(*RAW_COLUMNS),
        "b": raw.filter(~still_open & (F.col("line") > 3)).select(*reversed(RAW_COLUMNS)),
        "c": raw.filter(still_open).select(*sorted(set(RAW_COLUMNS) - {"closed_date"})),
    }
    for name, rows in parts.items():
        rows.write.options(**output(LANDING_CODEC)).csv(f"{root}/{name}", **plain)
    run_lake(lake, read_csv(spark, f"{root}/*"), "only", DAY_1)
    return lake.silver()


def src_csv_roundtrip(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    raw_only(raw_requests(spark, sf_dir)).write.csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return read_csv(spark, path)


def landing_jsonl_roundtrip(spark, sf_dir):
    path = fresh_dir(spark, "jsonl")
    with shuffles_freed(spark):
        write_jsonl(raw_requests(spark, sf_dir), path, LANDING_CODEC)
    return read_jsonl(spark, path)


def batch_fingerprint(spark, sf_dir):
    return fingerprint(raw_requests(spark, sf_dir))


def _ingest(rows: DataFrame, root: str, at: datetime):
    return bronze.ingest(rows, root, ingest_date=at.date(), ingested_at=at, source="orders")


def bronze_ingest(spark, sf_dir):
    root = fresh_dir(spark, "bronze")
    _ingest(raw_requests(spark, sf_dir), root, DAY_1)
    return bronze.scan(spark, root).drop("_batch_id")


def landing_resume(spark, sf_dir):
    """An attempt that stopped half way left a part of the rows; the next one stores all of them."""
    root = fresh_dir(spark, "bronze")
    raw = stored(raw_requests(spark, sf_dir).select(*RAW_COLUMNS, "line"), "raw")
    batch = fingerprint(raw).first()["batch_id"]
    write_jsonl(raw.filter("line = 1"), f"{root}/landing/{batch}", LANDING_CODEC)
    _ingest(raw, root, DAY_1)
    return bronze.scan(spark, root).drop("_batch_id")


def bronze_reingest_idempotent(spark, sf_dir):
    """The same rows in another order, and by other tasks, on the same day replace their own batch."""
    root, raw = fresh_dir(spark, "bronze"), stored_raw(spark, sf_dir, "line")
    late = F.coalesce(F.col("line") > 3, F.lit(False))
    first = _ingest(raw, root, DAY_1)
    again = _ingest(raw.filter(late).unionByName(raw.filter(~late)), root, DAY_1.replace(hour=6))
    return (
        bronze.scan(spark, root)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("_batch_id").alias("batches"),
            F.min("_ingested_at").alias("ingested_at"),
        )
        .withColumn("same_batch", F.lit(first.batch_id == again.batch_id))
    )


def bronze_scan(spark, sf_dir):
    """Several batches of several days as one relation with a typed partition column."""
    root = fresh_dir(spark, "bronze")
    for rows, at in zip(early_and_late(spark, sf_dir), (DAY_1, DAY_2), strict=True):
        _ingest(rows, root, at)
    return bronze.scan(spark, root).groupBy("ingest_date", "_source", "_ingested_at").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("unique_key").alias("keys")
    )


def bronze_manifest(spark, sf_dir):
    """What the manifest says of two deliveries, the second of which came twice."""
    root, (early, late) = fresh_dir(spark, "bronze"), early_and_late(spark, sf_dir)
    for rows, at in ((early, DAY_1), (late, DAY_2), (late, DAY_2.replace(hour=5))):
        _ingest(rows, root, at)
    return bronze.listed(spark, root).drop("_batch_id")


def stream_available_now(spark, sf_dir):
    """Two deliveries of files, each picked up once; a start without new files does nothing."""
    drops, root, memory = (fresh_dir(spark, n) for n in ("drops", "bronze", "stream"))
    for i, rows in enumerate(early_and_late(spark, sf_dir)):
        write_jsonl(rows, f"{drops}/delivery-{i}", LANDING_CODEC)
        for _ in range(2):
            ingest_new_files(
                spark, f"{drops}/*", root, memory, ingested_at=DAY_1, source="files"
            )
    return bronze.scan(spark, root).drop("_batch_id")


def stream_replay(spark, sf_dir):
    """A micro-batch that is replayed a day later replaces what its first attempt stored."""
    root, times, raw = fresh_dir(spark, "bronze"), fresh_dir(spark, "times"), stored_raw(spark, sf_dir)
    for now in (DAY_1, DAY_2):
        _ingest(raw, root, epoch_time(spark, times, 0, now))
    return bronze.scan(spark, root).drop("_batch_id")


# ---------------------------------------------------------------- runs


def run_state_roundtrip(spark, sf_dir):
    """Two records; the newest is the state a run starts from."""
    lake = new_lake(spark)
    newest = newest_created(spark, sf_dir).first()["newest"]
    for n, watermark in ((1, EPOCH), (2, newest)):
        values = {"run_id": f"r{n}", "published_run": f"r{n}", "since": EPOCH, "fetched": n, "watermark": watermark}
        lake.record(lake.state(), **values)
    newest_record = lake.run_log().filter(F.col("seq") == lake.state()["seq"])
    return newest_record.select("seq", "run_id", "since", "watermark", "published_run", "fetched")


def incremental_two_runs(spark, sf_dir):
    """A window up to a date, then the rest behind the watermark, folded into the first staging."""
    lake, raw = new_lake(spark), raw_requests(spark, sf_dir)
    run_lake(lake, raw, "first", DAY_1, until=datetime(1998, 1, 1))
    run_lake(lake, raw, "second", DAY_2, merge=True)
    return lake.silver()


def merge_few_new(spark, sf_dir):
    """Late versions of one key in a hundred, neighbours, are folded into staging of 64 buckets."""
    lake, raw = new_lake(spark), raw_requests(spark, sf_dir)
    few = F.coalesce(F.expr("try_cast(unique_key AS bigint)") % 25_600 < 256, F.lit(False)) & (F.col("line") > 3)
    cfg = replace(CFG, buckets=64, lookback_days=20_000)
    run_lake(lake, raw.filter(~few), "first", DAY_1, cfg)
    run_lake(lake, raw.filter(few), "second", DAY_2, cfg, merge=True)
    return lake.silver()


def run_log(spark, sf_dir):
    lake, raw = new_lake(spark), raw_requests(spark, sf_dir)
    run_lake(lake, raw, "first", DAY_1, until=datetime(1998, 1, 1))
    run_lake(lake, raw, "second", DAY_2)
    return lake.run_log().select(
        "seq", "run_id", "status", "source", "since", "fetched", "silver_rows", "good_rows",
        "quarantined", "fail_rate", "threshold", "watermark", "published_run",
        *[F.col("rule_failures")[r].alias(r) for r in rules()],
        *[F.col("gold_rows")[m].alias(m) for m in MART_NAMES],
    )


def late_update_lookback(spark, sf_dir):
    """Later versions carry the old creation time: only a lookback sees them."""
    lake, (early, late) = new_lake(spark), early_and_late(spark, sf_dir)
    run_lake(lake, early, "first", DAY_1)
    run_lake(lake, late, "second", DAY_2, replace(CFG, lookback_days=400))
    return lake.silver()


def rerun_idempotent(spark, sf_dir):
    """A second run fetches nothing; a forced one fetches all and changes nothing."""
    lake, raw = new_lake(spark), stored_raw(spark, sf_dir)
    run_lake(lake, raw, "first", DAY_1)
    run_lake(lake, raw, "again", DAY_1.replace(hour=1))
    everything = replace(CFG, lookback_days=20_000)
    run_lake(lake, raw, "forced", DAY_1.replace(hour=2), everything)
    stored_now = lake.bronze().agg(
        F.count(F.lit(1)).alias("bronze_rows"), F.countDistinct("_batch_id").alias("batches")
    )
    changed = lost_and_added(lake.silver("first"), lake.silver("forced"))
    log = lake.run_log().select("seq", "fetched", "good_rows", "watermark")
    return log.crossJoin(stored_now).crossJoin(changed)


def gate_failure_outcome(spark, sf_dir):
    """A failed run keeps its evidence and moves neither the visible run nor the watermark."""
    lake, (early, late) = new_lake(spark), early_and_late(spark, sf_dir)
    run_lake(lake, early, "good", DAY_1, until=datetime(1998, 1, 1))
    with suppress(gate.GateClosed):
        run_lake(lake, late, "bad", DAY_2, replace(CFG, threshold=0.001))
    evidence = lake.quarantine("bad").agg(F.count(F.lit(1)).alias("evidence_rows"))
    visible = lake.silver().agg(F.count(F.lit(1)).alias("visible_rows"))
    bronze_rows = lake.bronze().agg(F.count(F.lit(1)).alias("bronze_rows"))
    log = lake.run_log().select("seq", "status", "fetched", "watermark", "published_run")
    return log.crossJoin(evidence).crossJoin(visible).crossJoin(bronze_rows)


def gate_recovery(spark, sf_dir):
    """Corrected versions of the rejected requests let the next run pass under a 1 % gate."""
    lake, raw = new_lake(spark), raw_only(raw_requests(spark, sf_dir))
    strict = replace(CFG, threshold=0.01)
    with suppress(gate.GateClosed):
        run_lake(lake, raw, "bad", DAY_1, strict)
    missing = F.lit(None).cast("string")
    fixes = {
        "closed_date": missing,
        "resolution_action_updated_date": F.lit("2100-01-01T00:00:00.000"),
        "borough": F.lit("ASIA"),
        "latitude": missing,
        "longitude": missing,
    }
    broken = (
        (F.col("borough") == "Unspecified")
        | (F.col("latitude") == "0.000000")
        | (F.col("closed_date") < F.col("created_date"))
    )
    run_lake(lake, raw.filter(broken).withColumns(fixes), "fixed", DAY_2, strict)
    return key_text(lake.quarantine())


def limited_runs_complete(spark, sf_dir):
    """Runs with a limit that cuts among equal creation times, then one without: nothing is missing."""
    lake, raw = new_lake(spark), raw_requests(spark, sf_dir)
    # creation times by the day, so that every cut falls among equal ones
    days = F.concat(F.substring("created_date", 1, 10), F.lit("T00:00:00.000"))
    raw = stored(raw.withColumn("created_date", days), "days")
    run_lake(lake, raw, "first", DAY_1, limit=20_000)
    run_lake(lake, raw, "second", DAY_2, limit=5, merge=True)
    run_lake(lake, raw, "third", DAY_3, merge=True)
    return lake.silver().drop("ingest_date")


def merge_older_reingest(spark, sf_dir):
    """A batch that comes back with an earlier ingest time: merging gives what a rebuild gives."""
    lake = new_lake(spark)
    raw = stored_raw(spark, sf_dir, "line")
    early, late = raw.filter("line <= 3"), raw.filter("line > 3")
    always = replace(CFG, lookback_days=20_000)
    run_lake(lake, early, "first", DAY_2, always, ingest_date=DAY_1.date())
    run_lake(lake, late, "second", DAY_2, always, ingest_date=DAY_1.date(), merge=True)
    run_lake(lake, early, "again", DAY_1, always, ingest_date=DAY_1.date(), merge=True)
    return lake.silver()


def marts_rebuilt(spark, sf_dir):
    """The SLA mart under another limit: a record of its own, all marts of one id, the run as it was."""
    lake = new_lake(spark)
    run_lake(lake, raw_requests(spark, sf_dir), "only", DAY_1)
    rebuild_marts(lake, replace(CFG, sla_hours=24), "sla-24")
    log = lake.run_log().groupBy().agg(
        F.count(F.lit(1)).alias("records"), F.max_by("marts_run", "seq").alias("marts_run"), F.max_by("published_run", "seq").alias("published_run")
    )
    return lake.mart("sla_breach_rate").crossJoin(F.broadcast(log))  # one row


def lake_report(spark, sf_dir):
    """Everything the report quotes, from a published lake."""
    lake = new_lake(spark)
    run_lake(lake, raw_requests(spark, sf_dir), "only", DAY_1)
    return report.lake_stats(lake, list(rules())).drop("bronze_batches")


def gold_order(spark, sf_dir):
    """Each mart's rows numbered in display order."""
    lake = new_lake(spark)
    run_lake(lake, raw_requests(spark, sf_dir), "only", DAY_1)
    placed = None
    for name, keys in marts.MART_ORDER.items():
        rows = marts.numbered(lake.mart(name), name).select(
            F.lit(name).alias("mart"), "position", *[F.col(k).cast("string").alias(f"key_{i}") for i, k in enumerate(keys)]
        )
        placed = rows if placed is None else placed.unionByName(rows)
    return placed


def silver_published(spark, sf_dir):
    lake = new_lake(spark)
    run_lake(lake, raw_requests(spark, sf_dir), "only", DAY_1, sort_silver=True)
    return lake.silver()


def catalog_tables(spark, sf_dir):
    """Row and column counts of every registered table, read by name."""
    lake = new_lake(spark)
    run_lake(lake, raw_requests(spark, sf_dir), "only", DAY_1)
    database = "ticketlake_" + lake.root.rsplit("-", 1)[1]
    counts = None
    for name in catalog.register(lake, database):
        table = spark.table(f"{database}.{name}")
        one = table.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(len(table.columns)).alias("columns"), "rows"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


# ---------------------------------------------------------------- report


def report_bronze_stats(spark, sf_dir):
    raw = raw_requests(spark, sf_dir).select("unique_key", "_batch_id")
    return report.bronze_stats(stored(raw, "keys"))


def report_silver_stats(spark, sf_dir):
    return report.silver_stats(silver(spark, sf_dir))


def report_rule_counts(spark, sf_dir):
    return report.rule_counts(gate.quarantined(judged(spark, sf_dir)), list(rules()))


def _sla(spark, sf_dir):
    return stored(gold_sla_breach_72(spark, sf_dir), "sla")


def report_agency_breach(spark, sf_dir):
    return report.agency_breach(_sla(spark, sf_dir))


def report_sla_grid(spark, sf_dir):
    return report.sla_grid(_sla(spark, sf_dir))


def report_response_series(spark, sf_dir):
    return report.response_series(gold_response_time(spark, sf_dir), CFG.areas)


def _complaints(spark, sf_dir):
    return stored(gold_top_complaints(spark, sf_dir), "complaints")


def report_busiest_zips(spark, sf_dir):
    return report.busiest_zips(_complaints(spark, sf_dir))


def report_zip_complaints(spark, sf_dir):
    return report.zip_complaints(_complaints(spark, sf_dir))


def report_stats(spark, sf_dir):
    all_judged = stored(judged(spark, sf_dir), "judged")
    good = gate.good(all_judged)
    built = {n: stored(m, n) for n, m in marts.build_marts(good, CFG).items()}
    raw = stored(raw_requests(spark, sf_dir).select("unique_key", "_batch_id"), "keys")
    return report.stats(
        raw, good, gate.quarantined(all_judged), built, list(rules()), CFG.threshold, "orders"
    )


def report_layer_summary(spark, sf_dir):
    return report.layer_summary(report_stats(spark, sf_dir), MART_NAMES)


def report_summary_lines(spark, sf_dir):
    return report.summary_lines(report_stats(spark, sf_dir), list(rules()))


def report_gate(spark, sf_dir):
    return report.gate_panel(report_stats(spark, sf_dir), list(rules()))


def report_tiles(spark, sf_dir):
    return report.tiles(report_stats(spark, sf_dir), MART_NAMES)


QUERIES: dict[str, Query] = {
    "stage_typed": stage_typed,
    "zip_normalise": zip_normalise,
    "category_normalise": category_normalise,
    "elapsed_hours": elapsed_hours,
    "silver_staged": silver_staged,
    "dedup_latest": dedup_latest,
    "stage_incremental": stage_incremental,
    "extract_window": extract_window,
    "extract_first_n": extract_first_n,
    "extract_page": extract_page,
    "newest_created": newest_created,
    "effective_since": effective_since,
    "watermark_advance": watermark_advance,
    "rule_keys": _violations("non_null_keys"),
    "rule_category": _violations("valid_borough"),
    "rule_time_order": _violations("closed_not_before_created"),
    "rule_bbox": _violations("latlon_in_nyc_bbox"),
    "gate_tags": gate_tags,
    "gate_report": gate_report,
    "quarantine": quarantine,
    "silver_published": silver_published,
    "gate_partition_invariant": gate_partition_invariant,
    "gold_response_time": gold_response_time,
    "complaint_counts": complaint_counts,
    "gold_top_complaints": gold_top_complaints,
    "sla_flagged": sla_flagged,
    "gold_sla_breach_72": gold_sla_breach_72,
    "gold_sla_breach_24": gold_sla_breach_24,
    "gold_row_counts": gold_row_counts,
    "src_paged_window": src_paged_window,
    "paged_run": paged_run,
    "csv_run": csv_run,
    "src_csv_roundtrip": src_csv_roundtrip,
    "landing_jsonl_roundtrip": landing_jsonl_roundtrip,
    "batch_fingerprint": batch_fingerprint,
    "bronze_ingest": bronze_ingest,
    "bronze_reingest_idempotent": bronze_reingest_idempotent,
    "landing_resume": landing_resume,
    "bronze_scan": bronze_scan,
    "bronze_manifest": bronze_manifest,
    "stream_replay": stream_replay,
    "stream_available_now": stream_available_now,
    "run_state_roundtrip": run_state_roundtrip,
    "incremental_two_runs": incremental_two_runs,
    "merge_few_new": merge_few_new,
    "run_log": run_log,
    "late_update_lookback": late_update_lookback,
    "rerun_idempotent": rerun_idempotent,
    "gate_failure_outcome": gate_failure_outcome,
    "gate_recovery": gate_recovery,
    "limited_runs_complete": limited_runs_complete,
    "merge_older_reingest": merge_older_reingest,
    "marts_rebuilt": marts_rebuilt,
    "lake_report": lake_report,
    "gold_order": gold_order,
    "catalog_tables": catalog_tables,
    "report_bronze_stats": report_bronze_stats,
    "report_silver_stats": report_silver_stats,
    "report_rule_counts": report_rule_counts,
    "report_agency_breach": report_agency_breach,
    "report_sla_grid": report_sla_grid,
    "report_response_series": report_response_series,
    "report_busiest_zips": report_busiest_zips,
    "report_zip_complaints": report_zip_complaints,
    "report_stats": report_stats,
    "report_layer_summary": report_layer_summary,
    "report_summary_lines": report_summary_lines,
    "report_gate": report_gate,
    "report_tiles": report_tiles,
}
