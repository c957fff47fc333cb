"""Paths in whatever store Spark reads and writes."""

from pyspark.sql import SparkSession


def path_of(spark: SparkSession, path: str):
    """A path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, system = path_of(spark, path)
    return system.exists(found)
