"""An append-only log of small records that stays cheap to read: numbered entries and a compacted table.

    <path>/<number>-<attempt>/record.json  one record; the number is part of the name
    <path>/<number>-<attempt>/_SUCCESS     written after it
    <path>-compacted/<number>-<attempt>/   all records up to that number, Parquet

An entry counts once it is marked; nothing is moved. The newest is found by name. Every `every` records the log is compacted;
what the table before the last one holds is then deleted as entries, so a reader that has just looked up the
names still finds its files. So a read opens at most one table and 2 * every entries, however long the log is.
"""

from __future__ import annotations

import json
import re
import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.sources import fs

EVERY = 32
_NUMBER = re.compile(r"/(\d{12})-[0-9a-f]{32}/")


class RecordLog:
    """`schema` holds a long column `seq`. With `key`, only the newest record of each key matters, and compaction drops
    the others."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: tuple[str, ...] = (), every: int = EVERY):
        self.spark, self.path, self.schema, self.key, self.every = spark, path.rstrip("/"), schema, key, every

    def entries(self) -> list[tuple[int, str]]:
        """Number and file of the committed entries that are left, oldest first."""
        done = [f.removesuffix("_SUCCESS") for f in fs.glob(self.spark, f"{self.path}/*/_SUCCESS")]
        return sorted((int(m.group(1)), f"{f}record.json") for f in done if (m := _NUMBER.search(f)))

    def compacted(self) -> list[tuple[int, str]]:
        """Number and folder of the complete tables, oldest first."""
        done = [f.removesuffix("_SUCCESS") for f in fs.glob(self.spark, f"{self.path}-compacted/*/_SUCCESS")]
        return sorted((int(_NUMBER.search(f).group(1)), f) for f in done)

    def newest(self) -> tuple[int, list[str]]:
        """The last number (0: none) and the files that have it; several come from writers at the same time."""
        entries = self.entries()
        last = entries[-1][0] if entries else 0
        return last, [file for number, file in entries if number == last]

    def rows(self) -> DataFrame:
        """Every record, of each key the newest."""
        tables = self.compacted()
        upto, table = tables[-1] if tables else (0, None)
        files = [f for number, f in self.entries() if number > upto]
        out = self.spark.read.schema(self.schema).parquet(table) if table else self.spark.createDataFrame([], self.schema)
        if files:
            out = out.unionByName(self.read(files))
        if not self.key:
            return out
        order = Window.partitionBy(*self.key).orderBy(F.col("seq").desc(), *[F.col(c).desc() for c in out.columns])
        return out.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")

    def read(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).json(files)

    def append(self, number: int, values: dict) -> Row:
        """Write a record under a number; compacts when it is due."""
        row = {name: (values | {"seq": number}).get(name) for name in self.schema.fieldNames()}
        folder = f"{self.path}/{number:012d}-{uuid.uuid4().hex}"
        fs.write_text(self.spark, f"{folder}/record.json", json.dumps(row, default=lambda moment: moment.isoformat()))
        fs.write_text(self.spark, f"{folder}/_SUCCESS", "")
        tables = self.compacted()
        if number - (tables[-1][0] if tables else 0) >= self.every:
            self.compact(number, tables)
        return Row(**row)

    def record(self, file: str) -> Row:
        """One record, read on its own."""
        values = json.loads(fs.read_text(self.spark, file))
        kinds = {T.DateType(): date.fromisoformat, T.TimestampNTZType(): datetime.fromisoformat}
        for field in self.schema.fields:
            if values[field.name] is not None and field.dataType in kinds:
                values[field.name] = kinds[field.dataType](values[field.name])
        return Row(**values)

    def compact(self, upto: int, tables: list[tuple[int, str]]) -> None:
        """Fold everything up to a number into a new table; delete entries that the table before has, and older tables."""
        numbers = [n for n, _ in self.entries() if n <= upto]
        if len(set(numbers)) < len(numbers) and not self.key:
            return  # two writers had one number: left for whoever reads to notice
        rows = self.rows().filter(F.col("seq") <= upto)
        rows.coalesce(1).write.parquet(f"{self.path}-compacted/{upto:012d}-{uuid.uuid4().hex}")
        if tables:
            for number, file in self.entries():
                if number <= tables[-1][0]:
                    fs.delete(self.spark, file.rsplit("/", 1)[0])
        for _, folder in tables[:-1]:
            fs.delete(self.spark, folder)
