"""Run every registered query beside its SQL counterpart and report differences.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES
from ticketlake.config import SESSION_SETTINGS, made_dirs
from ticketlake.sources import fs


def session(cores: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ticketlake-checks")
    settings = {
        **SESSION_SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def normal_rows(table: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, NULLs as None, floats by repr; sorted."""
    table = table[sorted(table.columns)].astype(object)
    rows = []
    for record in table.itertuples(index=False, name=None):
        row = []
        for value in record:
            if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
                row.append("∅")
            elif isinstance(value, float):
                row.append(repr(float(value)))
            elif hasattr(value, "isoformat"):
                row.append(pd.Timestamp(value).isoformat())
            elif isinstance(value, bool):
                row.append(str(value))
            elif hasattr(value, "item"):
                row.append(repr(value.item()))
            else:
                row.append(str(value))
        rows.append(tuple(row))
    return sorted(rows)


def difference(spark_table: pd.DataFrame, duck_table: pd.DataFrame) -> str:
    if sorted(spark_table.columns) != sorted(duck_table.columns):
        return f"columns {sorted(spark_table.columns)} against {sorted(duck_table.columns)}"
    left, right = normal_rows(spark_table), normal_rows(duck_table)
    if left == right:
        return ""
    only_left = sorted(set(left) - set(right))[:2]
    only_right = sorted(set(right) - set(left))[:2]
    return f"rows {len(left)} against {len(right)}; {only_left} against {only_right}"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = session(), connect(sf_dir)
    failures = 0
    for name in names:
        start = time.time()
        try:
            table = QUERIES[name](spark, sf_dir).toPandas()
            seconds = time.time() - start
            note = difference(table, con.execute(ORACLE[name]).df()) if name in ORACLE else "no SQL"
        except Exception as error:  # report and go on with the next query
            seconds, table = time.time() - start, []
            note = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(note)
        for folder in made_dirs():
            fs.delete(spark, folder)
        print(f"{name:<28} {len(table):>7} rows {seconds:6.1f} s  {note or 'equal'}", flush=True)
    print(f"{failures} of {len(names)} differ")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
