from __future__ import annotations

import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from ticketlake.functions import casts, numeric, text

NUMBERS = [
    "12", " 12 ", "+5", "-7", "007", "12.5", "-12.5", "12.49", "1e3", "1e-1", "5e-1", "1.", ".5",
    "abc", "", " ", "n/a", "9999999999999999999", "9223372036854775807", "1d", "1f", "2.5D", "NaN",
]
TIMES = [
    "2024-03-01T10:00:00.000", "2024-03-01 10:00:00", "2024-3-1 1:2:3", "2024-03-01 10:00",
    "2024-03-01T10", "2024-03-01", " 2024-03-01 ", "2024-03-01 ", "2024", "2024-03", "2024-02-30",
    "2024-03-01x", "2024-03-01T10:00:00+05:00", "2024-03-01T10:00:00Z", "2024-03-01T",
    "2024-03-01 10:00:00.123456", "soon", "", "2024-13-01", "2024-03-01T25:00:00",
    "1969-12-31T23:59:59.900",
]


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def duck(values, type_name):
    con = duckdb.connect()
    return [con.execute(f"SELECT try_cast(? AS {type_name})", [v]).fetchall()[0][0] for v in values]


@pytest.mark.parametrize(
    ("cast", "type_name", "values"),
    [
        (casts.to_bigint, "BIGINT", NUMBERS),
        (casts.to_double, "DOUBLE", NUMBERS),
        (casts.to_timestamp, "TIMESTAMP", TIMES),
    ],
)
def test_casts_read_the_same_text_as_the_sql_engine(spark, cast, type_name, values):
    got = [r[0] for r in column(spark, values).select(cast(F.col("x"))).collect()]
    assert [repr(v) for v in got] == [repr(v) for v in duck(values, type_name)]


def test_round_half_away_is_the_binary_rounding_of_the_sql_engine(spark):
    rng = random.Random(7)
    values = [rng.uniform(-500, 500) for _ in range(500)] + [i / 200 for i in range(-400, 400)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(numeric.round_half_away(F.col("x"), 2)).collect()]
    con = duckdb.connect()
    assert got == [con.execute("SELECT round(?::DOUBLE, 2)", [v]).fetchall()[0][0] for v in values]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_seconds_between_counts_boundaries_in_any_session_zone(spark, zone):
    start = datetime(2024, 3, 10, 1, 59, 59, 900000)
    pairs = [(start, start + timedelta(milliseconds=200)), (start, start + timedelta(hours=3)),
             (start, start - timedelta(seconds=5)), (datetime(1969, 12, 31, 23, 59, 59, 500000),
             datetime(1970, 1, 1)), (start, None)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
        got = [r[0] for r in df.select(numeric.seconds_between(F.col("a"), F.col("b"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    con = duckdb.connect()
    query = "SELECT date_diff('second', ?::TIMESTAMP, ?::TIMESTAMP)"
    assert got == [con.execute(query, list(p)).fetchall()[0][0] for p in pairs]


def test_postcode_and_category(spark):
    zips = column(spark, ["10001", "11201-1234", "112011", " 10002 ", "1000", "abc", "", None])
    got = [r[0] for r in zips.select(text.postcode(F.col("x"))).collect()]
    assert got == ["10001", "11201", "11201", "10002", None, None, None, None]
    areas = column(spark, [" Staten Is ", "brooklyn", "Unspecified", "  ", "", None])
    alias = {"STATEN IS": "STATEN ISLAND"}
    got = [r[0] for r in areas.select(text.category(F.col("x"), alias)).collect()]
    assert got == ["STATEN ISLAND", "BROOKLYN", "UNSPECIFIED", None, None, None]
