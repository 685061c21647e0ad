"""Folder upkeep through Hadoop's file API, so any supported store works."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _folder(spark, path)
    return files.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    files, target = _folder(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def modified(spark: SparkSession, path: str) -> datetime:
    """When a file or folder was last changed (UTC)."""
    files, target = _folder(spark, path)
    return datetime.fromtimestamp(files.getFileStatus(target).getModificationTime() / 1000, timezone.utc)


def delete(spark: SparkSession, path: str) -> None:
    files, target = _folder(spark, path)
    files.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one go."""
    files, target = _folder(spark, path)
    out = files.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _folder(spark, path)
    source = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
