"""Filesystem helpers through Hadoop's FileSystem API, so they work on any
store the cluster mounts (HDFS, object stores), not just local disk."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            fs.delete(p, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, none if there is no such folder."""
    fs, p = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: the new content is complete before it takes the name."""
    fs, p = _fs(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(path + ".new")
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(fresh, p)
