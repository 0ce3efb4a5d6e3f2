"""Small helpers on Spark's file system layer, so that any path Spark can reach works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    path, fs = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(path) or []))


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file."""
    hadoop_path, fs = _path(spark, path)
    stream = fs.create(hadoop_path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    hadoop_path, fs = _path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
