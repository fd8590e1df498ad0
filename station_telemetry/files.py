"""Small file-system helpers that work on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.mkdirs(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when the folder does not exist."""
    fs, p = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Removes an existing folder when the driver's JVM ends."""
    fs, p = _open(spark, path)
    fs.deleteOnExit(p)


def age_folder(spark: SparkSession, root: str, name: str, days: int) -> None:
    """Puts the times of the files in folders called `name` below `root` back, as a restore may."""
    fs, p = _open(spark, root)
    listing = fs.listFiles(p, True)
    while listing.hasNext():
        status = listing.next()
        if status.getPath().getParent().getName() == name:
            then = status.getModificationTime() - days * 86_400_000
            fs.setTimes(status.getPath(), then, -1)
