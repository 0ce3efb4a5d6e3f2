from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import SparkSession

from ticketlake.config import RAW_COLUMNS, RAW_SCHEMA, SESSION_SETTINGS, LakeConfig, fresh_dir, made_dirs
from ticketlake.operators import gate, staging
from ticketlake.plans.lake import Lake
from ticketlake.plans.run import frame_fetcher, run
from ticketlake.sources import fs
from ticketlake.sources.bronze import with_lineage

T0 = datetime(2024, 4, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("ticketlake-tests")
    settings = {
        **SESSION_SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    for folder in made_dirs():
        fs.delete(session, folder)
    session.stop()


@pytest.fixture
def plain_session(spark):
    """A session with Spark's own defaults where SESSION_SETTINGS say otherwise."""
    session = spark.newSession()
    for key in SESSION_SETTINGS:
        session.conf.unset(key)
    return session


PLAIN = {
    "created_date": "2024-03-11T08:30:00.000",
    "agency": "PARKS",
    "complaint_type": "Fallen Tree",
    "descriptor": "Branch",
    "incident_zip": "11375",
    "borough": "QUEENS",
    "latitude": "40.72",
    "longitude": "-73.85",
}


def ticket(key=1, **fields):
    """The plain raw row with some fields changed (None: absent). It was last touched at the newest of its times."""
    row = PLAIN | {"unique_key": None if key is None else str(key)} | fields
    times = [row[c] for c in ("created_date", "closed_date") if row.get(c)]
    row = {"resolution_action_updated_date": max(times, default=None), **row}
    row["status"] = "Closed" if row.get("closed_date") else "Open"
    return tuple(row.get(c) for c in RAW_COLUMNS)


def iso(moment: datetime) -> str:
    return moment.isoformat(timespec="milliseconds")


def lasting(key, hours, start=datetime(2024, 3, 4), **fields):
    """A ticket that was closed so many hours after its start."""
    return ticket(key, created_date=iso(start), closed_date=iso(start + timedelta(hours=hours)), **fields)


@pytest.fixture
def raw(spark):
    def make(rows):
        return spark.createDataFrame(list(rows), RAW_SCHEMA)

    return make


@pytest.fixture
def bronze_of(raw):
    """Rows as one bronze batch, or several given as (rows, ingested_at)."""

    def make(*batches):
        out = None
        for i, (rows, at) in enumerate(batches):
            one = with_lineage(raw(rows), f"b{i}", "test", at, at.date())
            out = one if out is None else out.unionByName(one)
        return out

    return make


@pytest.fixture
def stage(bronze_of):
    def make(rows):
        return staging.staged(bronze_of((rows, T0)), LakeConfig())

    return make


@pytest.fixture
def silver(stage):
    def make(rows):
        return gate.good(gate.verdict(stage(rows), gate.default_rules(LakeConfig())))

    return make


@pytest.fixture
def lake(spark):
    return Lake(spark, fresh_dir(spark, "lake"))


@pytest.fixture
def run_rows(raw):
    """Run a lake once over the given rows."""
    count = iter(range(1000))

    def go(lake, rows, cfg=LakeConfig(), at=None, since=datetime(2024, 1, 1), **more):
        i = next(count)
        table = rows if hasattr(rows, "columns") else raw(rows)
        return run(
            lake,
            frame_fetcher(lambda _: table, cfg),
            source="test",
            since=since,
            run_id=more.pop("run_id", f"r{i}"),
            ingested_at=at or T0 + timedelta(minutes=i),
            cfg=cfg,
            **more,
        )

    return go


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


__all__ = ["RAW_COLUMNS", "date", "iso", "lasting", "rows_of", "ticket"]
