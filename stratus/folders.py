"""Files and folders of whatever file system a path belongs to, through Spark's own access to it."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones; none if it does not exist."""
    files, at = _open(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
    return sorted(n for n in names if not n.startswith("."))


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file."""
    files, at = _open(spark, path)
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all; an existing one is an error."""
    files, at = _open(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(at) or not files.rename(draft, at):
        files.delete(draft, False)
        raise FileExistsError(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    files, at = _open(spark, path)
    files.delete(at, True)
