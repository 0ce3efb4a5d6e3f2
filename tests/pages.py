"""A stand-in for a paged service: the pages of one window, each stored as a file of its own."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.config import RAW_COLUMNS, fresh_dir
from ticketlake.operators.extract import in_window, numbered


class StoredPages:
    """A page reader that hands out stored pages and knows nothing but their numbers.

    It serves one window and one page size, those it was written for.
    """

    def __init__(self, root: str, since: str, until: str | None, size: int):
        self.root, self.window, self.size = root, (since, until), size

    def __call__(self, since: str, until: str | None, columns: Sequence[str], offset: int, size: int) -> pa.Table:
        if (since, until) != self.window or size > self.size or offset % self.size:
            raise ValueError(f"no page at {offset} of {size} rows in {since} .. {until}")
        uri = self.root if "://" in self.root else "file://" + self.root.removeprefix("file:")
        files, root = FileSystem.from_uri(uri)
        folder = f"{root}/page={offset // self.size}"
        if files.get_file_info(folder).type == FileType.NotFound:
            return pa.schema([(c, pa.string()) for c in columns]).empty_table()
        rows = ds.dataset(folder, filesystem=files, format="parquet").to_table(columns=[*columns, "position"])
        return rows.sort_by("position").select(list(columns)).slice(0, size)


def write_pages(raw: DataFrame, since: str, until: str | None, size: int, row_id: Sequence[str] = ()) -> StoredPages:
    """Store the window's rows, page by page in the source order."""
    root = fresh_dir(raw.sparkSession, "pages")
    rows = numbered(in_window(raw.select(*RAW_COLUMNS, *row_id), since, until), row_id)
    rows = rows.withColumn("page", F.floor(F.col("position") / size))
    # one task a page; a page is no larger than the service would send at once
    rows.repartition("page").write.partitionBy("page").parquet(root)
    return StoredPages(root, since, until, size)
