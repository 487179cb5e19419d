"""Folder operations on whatever file system Spark writes to (HDFS, object stores, local).

Spark has no DataFrame API for listing or removing folders, so these few calls
go through the Hadoop file system that the session is configured with.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, sorted; none if it doesn't exist."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds; False if there was none."""
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as UTF-8 text, also one that Spark's file sources hide ('_' or '.' prefix)."""
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
