"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose input and cores.
Every query runs from the source tables; the reported time is the median of three after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from checks import queries as q
from checks.compare import session
from pyspark.sql import DataFrame, SparkSession
from ticketlake.config import made_dirs
from ticketlake.sources import fs

HEADLINE = (
    "silver_staged",
    "gate_report",
    "gold_response_time",
    "gold_top_complaints",
    "gold_sla_breach_72",
    "dedup_latest",
    "batch_fingerprint",
    "bronze_ingest",
)
REPEATS = 3


def consume(df: DataFrame) -> None:
    """Compute every row and column without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def full_run(spark: SparkSession, sf_dir: str) -> None:
    """Extract, bronze, staging, gate and all marts into a new lake."""
    q.run_lake(q.new_lake(spark), q.raw_requests(spark, sf_dir), "only", q.DAY_1)


def timed(spark: SparkSession, work: Callable[[], None]) -> float:
    seconds = []
    for _ in range(1 + REPEATS):
        start = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - start)
        for folder in made_dirs():  # what the queries stored
            fs.delete(spark, folder)
    seconds = seconds[1:]
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cores)
    names = sys.argv[1:] or [*HEADLINE, "full_run"]
    results = {}
    for name in names:
        if name == "full_run":
            results[name] = timed(spark, lambda: full_run(spark, sf_dir))
        else:
            results[name] = timed(spark, lambda n=name: consume(q.QUERIES[n](spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
