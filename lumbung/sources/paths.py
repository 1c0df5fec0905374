"""Existence checks and listings through the Hadoop file system, so any storage works."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _open(spark, path)
    return file_system.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    file_system, hadoop_path = _open(spark, path)
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]


def bytes_below(spark: SparkSession, path: str) -> int:
    """The bytes of the files that a path or pattern names, folders with all that is in them; 0 where nothing is."""
    file_system, hadoop_path = _open(spark, path)
    found = file_system.globStatus(hadoop_path) or []
    return sum(file_system.getContentSummary(status.getPath()).getLength() for status in found)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the file system remove the folder when the application ends."""
    file_system, hadoop_path = _open(spark, path)
    file_system.deleteOnExit(hadoop_path)


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(conf), hadoop_path


def read_text(spark: SparkSession, path: str) -> str:
    file_system, hadoop_path = _open(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that is there as a whole or not at all; False where ``path`` is taken already."""
    file_system, hadoop_path = _open(spark, path)
    folder, name = path.rsplit("/", 1)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    file_system.mkdirs(hadoop_path.getParent())
    stream = file_system.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if file_system.exists(hadoop_path) or not file_system.rename(draft, hadoop_path):
        file_system.delete(draft, False)
        return False
    return True


def delete(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _open(spark, path)
    file_system.delete(hadoop_path, True)


def age_in_hours(spark: SparkSession, path: str) -> float:
    file_system, hadoop_path = _open(spark, path)
    return time.time() / 3600 - file_system.getFileStatus(hadoop_path).getModificationTime() / 3.6e6
