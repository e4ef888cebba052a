"""Files and folders through Hadoop's file systems, so that paths of any store work."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.delete(at, True)
