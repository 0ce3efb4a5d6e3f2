"""A windowed, paged service as a Spark data source: every task reads its own pages.

The service is a callable given by the user, `read_page(since, until, columns, offset, size)`,
which returns at most `size` records of the window, oldest first: dicts with missing fields left
out, or an Arrow table of text columns. It runs inside the tasks and must be picklable.
"""

from __future__ import annotations

import base64
import sys
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThan, InputPartition, LessThanOrEqual

from ticketlake.config import RAW_COLUMNS, LakeConfig
from ticketlake.plans.run import Fetcher

FORMAT = "paged_requests"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
# The responses that are worth another try.
RETRY_STATUS = (429, 500, 502, 503, 504)
# Seconds to wait before each further try of a page.
RETRY_DELAYS = (1.0, 2.0, 4.0, 8.0)
# Tasks of a read that take turns over its pages, unless the caller names another number.
STREAMS = 64

Records = "Iterable[dict] | pa.Table"
PageReader = Callable[["str | None", "str | None", Sequence[str], int, int], Records]


class TransientPageError(Exception):
    """The service may answer the same request later (raise it from a page reader)."""


class PageReadError(RuntimeError):
    """A page could not be read, after retries or at once."""


def check_status(status: int) -> None:
    """For page readers over a web service: sort failures into worth retrying and not."""
    if status in RETRY_STATUS:
        raise TransientPageError(f"status {status}")
    if status >= 400:
        raise PageReadError(f"status {status}")


def patiently(request: Callable, delays: Iterable[float] = RETRY_DELAYS, pause=time.sleep):
    """The request's answer; a passing failure is asked again after each of the delays, others end it.

    Lost connections and timeouts pass like a TransientPageError.
    """
    schedule = iter(delays)
    while True:
        try:
            return request()
        except (TransientPageError, ConnectionError, TimeoutError) as failure:
            wait = next(schedule, None)
            if wait is None:
                raise PageReadError(f"the service kept failing: {failure}") from failure
        pause(wait)


def as_table(records: Records) -> pa.Table:
    text = pa.schema([(c, pa.string()) for c in RAW_COLUMNS])
    if isinstance(records, pa.Table):
        return records.select(text.names).cast(text)
    rows = list(records)
    return pa.table([pa.array([r.get(c) for r in rows], pa.string()) for c in text.names], text)


class Turns(InputPartition):
    """Pages first, first + step, first + 2 * step and so on."""

    def __init__(self, first: int, step: int):
        self.first, self.step = first, step


class PagedReader(DataSourceReader):
    """Reads the window that the options give. Spark refuses a reader that takes filters in sessions that don't push
    them, so this one takes none."""

    def __init__(self, options: dict):
        self.read_page = cloudpickle.loads(base64.b64decode(options["reader"]))
        self.since, self.until = options.get("since"), options.get("until")
        self.limit = int(options["limit"]) if "limit" in options else None
        self.page_size, self.streams = int(options["pagesize"]), int(options["streams"])
        self.delays = [float(x) for x in options["delays"].split(",") if x]

    def partitions(self) -> list[Turns]:
        """Tasks that take turns over the pages. The number of pages need not be known: each goes on to its
        first short page, so at most one request a task lies past the window."""
        pages = self.streams if self.limit is None else -(-self.limit // self.page_size)
        step = max(1, min(self.streams, pages))
        return [Turns(first, step) for first in range(step)]

    def read(self, turns: Turns) -> Iterator[pa.RecordBatch]:
        page = turns.first
        while True:
            offset = page * self.page_size
            size = self.page_size if self.limit is None else min(self.page_size, self.limit - offset)
            if size <= 0:
                return
            got = patiently(
                lambda at=offset, n=size: as_table(self.read_page(self.since, self.until, RAW_COLUMNS, at, n)),
                self.delays,
            )
            if got.num_rows > size:
                raise PageReadError(f"asked for {size} records, got {got.num_rows}")
            yield from got.to_batches()
            if got.num_rows < size:
                return
            page += turns.step


class NarrowingReader(PagedReader):
    """For sessions that push filters down: bounds on the creation text narrow the window."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Only without a limit: the rows of a limit are those of the window it was given with."""
        for f in filters:
            on_time = self.limit is None and getattr(f, "attribute", None) == ("created_date",)
            if on_time and isinstance(f, GreaterThan):
                self.since = max(self.since or "", f.value)
            elif on_time and isinstance(f, LessThanOrEqual):
                self.until = f.value if self.until is None else min(self.until, f.value)
            else:
                yield f


class PagedRequests(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ", ".join(f"{c} string" for c in RAW_COLUMNS)

    def reader(self, schema) -> PagedReader:
        narrowing = self.options["narrowing"] == "true"
        return NarrowingReader(self.options) if narrowing else PagedReader(self.options)


def _registered(spark: SparkSession) -> str:
    """The source's name in this session; another one where another session of the process holds the usual one."""
    try:
        spark.dataSource.register(PagedRequests)
        return FORMAT
    except AnalysisException as taken:
        if taken.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
    name = f"{FORMAT}_{uuid.uuid4().hex}"
    spark.dataSource.register(type("PagedRequests", (PagedRequests,), {"name": classmethod(lambda cls: name)}))
    return name


def read_paged(
    spark: SparkSession,
    read_page: PageReader,
    cfg: LakeConfig,
    since=None,
    until=None,
    limit: int | None = None,
    streams: int = STREAMS,
    delays: Sequence[float] = RETRY_DELAYS,
    narrowing: bool | None = None,
) -> DataFrame:
    """Records created after `since` and up to `until`, page by page; the oldest `limit` of them if given.

    The window travels to the service, so only matching records are transferred. Without a limit a filter
    `created_date > ...` or `<= ...` on the result travels there, too, if `narrowing`: by default where the session
    has `spark.sql.python.filterPushdown.enabled`, which must then stay on until the table is read.
    """
    cfg.check_limit(limit)
    if narrowing is None:
        narrowing = spark.conf.get(PUSHDOWN, "false") == "true"
    # classes and page readers travel by value: executors need no copy of this package
    cloudpickle.register_pickle_by_value(sys.modules["ticketlake"])
    try:
        name = _registered(spark)
        options = {
            "reader": base64.b64encode(cloudpickle.dumps(read_page)).decode(),
            "since": None if since is None else _text(since),
            "until": None if until is None else _text(until),
            "limit": limit,
            "pageSize": cfg.page_size,
            "streams": streams,
            "delays": ",".join(map(str, delays)),
            "narrowing": str(narrowing).lower(),
        }
        given = {k: str(v) for k, v in options.items() if v is not None}
        return spark.read.format(name).options(**given).load()
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules["ticketlake"])


def paged_fetcher(read_page: PageReader, cfg: LakeConfig, streams: int = STREAMS) -> Fetcher:
    """The service as the source of a run."""

    def fetch(spark, since, until, limit):
        return read_paged(spark, read_page, cfg, since, until, limit, streams)

    return fetch


def _text(moment) -> str:
    """ISO text with milliseconds, the form in which records carry their times."""
    return moment if isinstance(moment, str) else moment.isoformat(timespec="milliseconds")
