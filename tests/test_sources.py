from __future__ import annotations

import gzip
import hashlib
import json
import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0, rows_of, ticket
from tests.pages import write_pages
from ticketlake.config import RAW_COLUMNS, LakeConfig, fresh_dir, shared_root
from ticketlake.operators import extract
from ticketlake.operators.fingerprint import batch_id, fingerprint
from ticketlake.sources import bronze, files, paged
from ticketlake.sources.files import file_a_task, header_lines, read_csv, read_jsonl, write_jsonl
from ticketlake.streaming.landing import epoch_time, ingest_new_files

CFG = LakeConfig()
START = datetime(2024, 1, 1)


def at(minutes):
    return (START + timedelta(minutes=minutes)).isoformat(timespec="milliseconds")


def hourly(n):
    return [ticket(i, created_date=at(60 * i)) for i in range(n)]


def ingest(rows, root, when=T0, day=date(2024, 3, 5)):
    return bronze.ingest(rows, root, ingest_date=day, ingested_at=when, source="test")


# ---------------------------------------------------------------- files


def test_csv_is_read_by_header_name_and_empty_cells_are_missing(spark, tmp_path):
    file = tmp_path / "in.csv"
    file.write_text(
        'borough,unique_key,created_date,other,descriptor,agency\n'
        '"",7,2024-03-01T10:00:00.000,x,"a, ""b""",\n'
        " QUEENS ,8,2024-03-01T11:00:00.000,y,c,NYPD\n"
    )
    table = read_csv(spark, str(file))
    assert table.columns == list(RAW_COLUMNS)
    assert [tuple(r) for r in table.select("unique_key", "borough", "descriptor", "agency", "status").orderBy("unique_key").collect()] == [
        ("7", None, 'a, "b"', None, None),
        ("8", " QUEENS ", "c", "NYPD", None),
    ]


def test_files_with_other_headers_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("unique_key,agency,created_date\n1,HPD,2024-03-02T00:00:00.000\n")
    (tmp_path / "b.csv").write_text('created_date,agency,"unique_key"\n2024-03-03T00:00:00.000,DOT,2\n')
    (tmp_path / "c.csv").write_text("")
    got = rows_of(read_csv(spark, str(tmp_path)), "unique_key", "agency", "created_date", "borough")
    assert got == [("1", "HPD", "2024-03-02T00:00:00.000", None), ("2", "DOT", "2024-03-03T00:00:00.000", None)]


@pytest.mark.parametrize("opening", ["4194304", "1"])
def test_headers_are_found_by_tasks_also_of_odd_names_and_blocks(spark, tmp_path, opening):
    """Files of several blocks, compressed ones, a byte order mark, names with signs that paths give a meaning."""
    header = "unique_key,agency,created_date\n"
    (tmp_path / "a [1]{x}.csv").write_text("\ufeff" + header + "".join(f"{i},A,2024-03-02T00:00:00.000\n" for i in range(400)))
    (tmp_path / "b%20c.csv").write_text("agency,unique_key,created_date\r\nB,1000,2024-03-02T00:00:00.000\r\n")
    with gzip.open(tmp_path / "d.csv.gz", "wt") as file:
        file.write(header + "2000,D,2024-03-02T00:00:00.000\n")
    (tmp_path / "e.csv").write_text("")
    sizes = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": opening}
    before = {k: spark.conf.get(k) for k in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        assert files.header_lines(spark, str(tmp_path)).count() == 3
        got = read_csv(spark, str(tmp_path)).groupBy("agency").agg(F.count(F.lit(1)), F.max(F.col("unique_key").cast("int")))
        assert sorted(map(tuple, got.collect())) == [("A", 400, 399), ("B", 1, 1000), ("D", 1, 2000)]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    (tmp_path / "f.csv").write_text("unique_key,unique_key\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_csv(spark, str(tmp_path))


@pytest.mark.parametrize("line", ["1,2,3", "1"])
def test_a_line_that_does_not_fit_its_header_fails(spark, tmp_path, line):
    file = tmp_path / "in.csv"
    file.write_text(f"unique_key,agency\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_csv(spark, str(file)).collect()


def test_landing_lines_have_sorted_present_fields(spark, raw, tmp_path):
    path = str(tmp_path / "out")
    rows = raw([ticket(1), ticket(None, closed_date="2024-03-02T00:00:00.000")])
    write_jsonl(rows.coalesce(1), path)
    text = next(Path(path).glob("part-*.json")).read_text().splitlines()
    first = json.loads(text[0])
    assert list(first) == sorted(c for c in RAW_COLUMNS if c != "closed_date")
    assert "unique_key" not in json.loads(text[1])
    assert read_jsonl(spark, path).exceptAll(rows).count() == 0


def test_numbers_stay_text_and_malformed_lines_fail(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    (good / "a.json").write_text('{"unique_key": 12, "latitude": 40.70, "extra": 1}\n')
    (bad / "a.json").write_text('{"unique_key": "1"\n')
    assert rows_of(read_jsonl(spark, str(good)), "unique_key", "agency") == [("12", None)]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_jsonl(spark, str(bad)).collect()


# ---------------------------------------------------------------- extract


def test_window_is_open_at_the_start_and_closed_at_the_end(raw):
    rows = raw([*hourly(6), ticket(99, created_date="soon", resolution_action_updated_date=at(0)), ticket(98, created_date=None, resolution_action_updated_date=at(0))])
    got = extract.in_window(rows, START + timedelta(hours=1), START + timedelta(hours=4))
    assert rows_of(got, "unique_key") == [("2",), ("3",), ("4",)]


def test_first_rows_and_pages_follow_the_source_order(raw):
    rows = raw([ticket("b", created_date=at(0)), ticket(None, created_date=at(0)), ticket("a", created_date=at(5)),
                ticket("a", created_date=at(0), resolution_action_updated_date=at(9)), ticket("a", created_date=at(0), resolution_action_updated_date=at(8))])
    got = [(r[0], r[1][-9:-4]) for r in extract.first_n(rows, 4).select("unique_key", "resolution_action_updated_date").collect()]
    assert got == [(None, "00:00"), ("a", "08:00"), ("a", "09:00"), ("b", "00:00")]
    assert [r[0] for r in extract.page(rows, 3, 10).select("unique_key").collect()] == ["b", "a"]


@pytest.mark.parametrize("limit", [0, 50_001])
def test_limit_beyond_the_cap_is_rejected_before_reading(raw, limit):
    with pytest.raises(ValueError):
        extract.extract(raw(hourly(1)), CFG, START, limit)


# ---------------------------------------------------------------- fingerprint and bronze


def test_fingerprint_ignores_order_and_partitioning_but_not_copies(raw):
    rows = hourly(50)
    ids = [
        fingerprint(table).first()["batch_id"]
        for table in (
            raw(rows), raw(rows[::-1]).repartition(7), raw([*rows, rows[0]]),
            raw([*rows, rows[1]]), raw(rows[1:]),
        )
    ]
    assert ids[0] == ids[1] and len(set(ids)) == 4
    assert len(ids[0]) == 17 and ids[0].startswith("b")
    assert tuple(fingerprint(raw([])).first()) == (None, 0)


def test_ingest_keeps_text_and_adds_lineage(spark, raw):
    root = fresh_dir(spark, "bronze")
    batch = ingest(raw([ticket(7, latitude="40.70"), ticket(8, created_date=at(9))]), root)
    assert (batch.rows, batch.newest) == (2, datetime(2024, 3, 11, 8, 30))
    row = bronze.scan(spark, root).filter("unique_key = '7'").first()
    assert (row["latitude"], row["closed_date"], row["_source"]) == ("40.70", None, "test")
    assert (row["_ingested_at"], row["ingest_date"], row["_batch_id"]) == (T0, date(2024, 3, 5), batch.batch_id)
    assert read_jsonl(spark, batch.landing).count() == 2
    assert rows_of(bronze.batches(bronze.scan(spark, root)), "ingest_date", "_batch_id") == [
        (date(2024, 3, 5), batch.batch_id)
    ]


def test_the_same_rows_replace_their_own_batch_only(spark, raw):
    root = fresh_dir(spark, "bronze")
    first = ingest(raw(hourly(20)), root)
    other = ingest(raw([ticket(500)]), root)
    again = ingest(raw(hourly(20)[::-1]), root, when=T0 + timedelta(hours=1))
    next_day = ingest(raw(hourly(20)), root, day=date(2024, 3, 6))
    assert first.batch_id == again.batch_id == next_day.batch_id != other.batch_id
    stored = bronze.scan(spark, root)
    assert bronze.batches(stored).count() == 3
    assert stored.count() == 41
    refreshed = stored.filter((F.col("ingest_date") == "2024-03-05") & (F.col("unique_key") == "3"))
    assert refreshed.first()["_ingested_at"] == T0 + timedelta(hours=1)


def test_no_rows_write_nothing(spark, raw):
    root = fresh_dir(spark, "bronze")
    batch = ingest(raw([]), root)
    assert batch == bronze.Batch(0)
    with pytest.raises(bronze.NoBronzeData):
        bronze.scan(spark, root)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


# ---------------------------------------------------------------- paged source


def service(rows, asked=None):
    """A page reader over rows in source order; notes in a file what it was asked for."""

    def read_page(since, until, columns, offset, size):
        if asked:
            with open(asked, "a") as notes:
                notes.write(f"{since} {until} {offset}\n")
        inside = [
            r for r in rows
            if (since is None or r["created_date"] > since) and (until is None or r["created_date"] <= until)
        ]
        return [{c: r[c] for c in columns if r.get(c) is not None} for r in inside[offset : offset + size]]

    return read_page


def as_dicts(rows):
    return [dict(zip(RAW_COLUMNS, r, strict=True)) for r in rows]


def keys(table):
    return sorted(int(r[0]) for r in table.select("unique_key").collect())


@pytest.mark.parametrize("n", [0, 1, 7, 8, 30, 49])
@pytest.mark.parametrize("streams", [1, 3, 64])
def test_a_window_of_unknown_size_is_read_to_its_end(spark, tmp_path, n, streams):
    notes = tmp_path / "asked"
    read = service(as_dicts(hourly(n)), str(notes))
    assert keys(paged.read_paged(spark, read, LakeConfig(page_size=7), streams=streams)) == list(range(n))
    offsets = [int(line.split()[-1]) for line in notes.read_text().splitlines()]
    assert len(offsets) == len(set(offsets))  # no page twice
    assert sum(o >= n for o in offsets) <= streams  # at most one request a task finds nothing


def test_a_limit_takes_the_oldest_of_the_window(spark):
    rows, cfg = as_dicts(hourly(30)), LakeConfig(page_size=7)
    start, end = START + timedelta(hours=2), START + timedelta(hours=40)
    assert keys(paged.read_paged(spark, service(rows), cfg, start, end, 20)) == list(range(3, 23))
    assert keys(paged.read_paged(spark, service(rows), cfg, limit=14, streams=1)) == list(range(14))
    for limit in (0, cfg.max_rows + 1):
        with pytest.raises(ValueError):
            paged.read_paged(spark, service(rows), cfg, limit=limit)


@pytest.mark.parametrize("limit", [None, 8])
def test_sessions_with_and_without_pushdown_read_the_same_rows(spark, plain_session, tmp_path, limit):
    rows, created, got = as_dicts(hourly(30)), F.col("created_date"), []
    for session, setting in ((spark, "true"), (plain_session, "false")):
        assert session.conf.get(paged.PUSHDOWN, "false") == setting
        table = paged.read_paged(session, service(rows), LakeConfig(page_size=4), at(60), at(60 * 20), limit)
        got.append((keys(table), keys(table.filter((created > at(60 * 4)) & (created <= at(60 * 9))))))
    assert got[0] == got[1] == ((list(range(2, 21)) if limit is None else list(range(2, 10))), list(range(5, 10)))


def test_bounds_in_a_filter_travel_to_the_service(spark, tmp_path):
    notes, rows = tmp_path / "asked", as_dicts(hourly(30))
    created = F.col("created_date")
    table = paged.read_paged(spark, service(rows, str(notes)), LakeConfig(page_size=50), streams=1)
    assert keys(table.filter((created > at(60 * 4)) & (created <= at(60 * 9)))) == list(range(5, 10))
    assert {line.rsplit(" ", 1)[0] for line in notes.read_text().splitlines()} == {f"{at(240)} {at(540)}"}
    limited = paged.read_paged(spark, service(rows), LakeConfig(), limit=10)
    assert keys(limited.filter(created > at(60 * 4))) == list(range(5, 10))  # a limit keeps its rows


def test_stored_pages_make_up_the_window(spark, raw):
    rows = raw([*hourly(100), *[ticket(7, created_date=at(60 * 7))] * 20]).repartition(5)
    pages = write_pages(rows, at(180), at(4200), 9)
    got = paged.read_paged(spark, pages, LakeConfig(page_size=9), at(180), at(4200))
    want = extract.in_window(rows, at(180), at(4200))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_failures_that_pass_are_asked_again_on_schedule(seed):
    """Against a plain reading of random schedules and answers."""
    rng = random.Random(seed)
    delays = [rng.randrange(1, 9) for _ in range(rng.randrange(5))]
    statuses = [rng.choice([*paged.RETRY_STATUS, 200, 404, "lost"]) for _ in range(8)]
    answers, waits = iter(statuses), []

    def request():
        status = next(answers)
        if status == "lost":
            raise ConnectionError
        paged.check_status(status)
        return status

    tries = next((i for i, s in enumerate(statuses) if s in (200, 404)), 99)
    if tries > len(delays) or statuses[tries] == 404:
        with pytest.raises(paged.PageReadError):
            paged.patiently(request, delays, waits.append)
    else:
        assert paged.patiently(request, delays, waits.append) == 200
    assert waits == delays[:tries]


# ---------------------------------------------------------------- streaming


def test_stream_takes_every_file_once(spark, raw):
    drops, root, memory = (fresh_dir(spark, n) for n in ("drops", "bronze", "stream"))

    def start():
        return ingest_new_files(spark, f"{drops}/*", root, memory, ingested_at=T0, source="files")

    write_jsonl(raw(hourly(10)), f"{drops}/a")
    assert (start(), start()) == (10, 0)
    write_jsonl(raw([ticket(100)]), f"{drops}/b")
    assert start() == 1
    assert bronze.scan(spark, root).count() == 11


def test_a_replayed_epoch_keeps_its_first_time(spark):
    times = fresh_dir(spark, "times")
    assert epoch_time(spark, times, 3, T0) == T0
    assert epoch_time(spark, times, 3, T0 + timedelta(days=2)) == T0
    assert epoch_time(spark, times, 4, T0 + timedelta(days=2)) == T0 + timedelta(days=2)


def test_the_landing_is_compressed_and_read_back_whole(spark, raw, tmp_path):
    rows = raw([ticket(i, descriptor="a long text, " * 50) for i in range(500)] + [ticket(None, agency='"é\n')])
    batch = ingest(rows, tmp_path)
    files = [f for f in Path(batch.landing).iterdir() if f.name.startswith("part-")]
    assert files and all(f.suffix == ".lz4" for f in files)
    plain = str(tmp_path / "plain")
    write_jsonl(rows, plain)
    size = sum(f.stat().st_size for f in Path(plain).glob("part-*.json"))
    assert 4 * sum(f.stat().st_size for f in files) < size
    assert rows.exceptAll(read_jsonl(spark, batch.landing)).isEmpty() and read_jsonl(spark, batch.landing).count() == 501


def test_batch_id_sums_are_whole_numbers_without_sign(spark):
    digests = ["f" * 64, "f" * 64, "0123456789abcdef" * 4, "8" + "0" * 63]
    sums = [sum(int(d[i : i + 16], 16) for d in digests) for i in range(0, 64, 16)]
    wanted = "b" + hashlib.sha256(":".join(map(str, [4, *sums])).encode()).hexdigest()[:16]
    table = spark.createDataFrame([(d,) for d in digests], "digest string")
    assert table.agg(batch_id(F.col("digest"))).first()[0] == wanted
    assert "DECIMAL(20,0))) AS STRING" not in str(batch_id(F.col("digest")))


def test_headers_of_compressed_files_are_found_without_reading_them_whole(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("cast(id as string) as unique_key", "'x' as agency").repartition(4)
    rows.write.option("compression", "lz4").csv(f"{tmp_path}/a", header=True)
    rows.select("agency", "unique_key").write.option("compression", "lz4").csv(f"{tmp_path}/b", header=True)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    with file_a_task(spark):
        assert header_lines(spark, f"{tmp_path}/*").rdd.getNumPartitions() == 8
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert header_lines(spark, f"{tmp_path}/*").rdd.getNumPartitions() < 8
    assert read_csv(spark, f"{tmp_path}/*").groupBy("agency").count().first()["count"] == 80_000
