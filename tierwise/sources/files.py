"""A few calls to the file system Spark itself uses for a path, on the driver.

Only names and small records pass here; tables are written and read by Spark.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.exists(at)


def listed(spark: SparkSession, path: str) -> dict[str, float]:
    """Visible names in a folder with the seconds at which each was last changed; empty if there is none."""
    fs, at = _open(spark, path)
    if not fs.exists(at):
        return {}
    found = {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(at)}
    return {name: when for name, when in found.items() if not name.startswith((".", "_"))}


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless the path is taken; tells whether it did."""
    fs, at = _open(spark, path)
    try:
        out = fs.create(at, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or fs.exists(at):
            return False
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def delete(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.delete(at, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """The driver's JVM deletes the path when it ends."""
    fs, at = _open(spark, path)
    fs.deleteOnExit(at)
