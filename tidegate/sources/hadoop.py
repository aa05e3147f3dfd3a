"""The few file-system calls a job makes on the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def matches(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern names at least one existing file or folder."""
    place, fs = _path(spark, path)
    found = fs.globStatus(place)
    return found is not None and len(found) > 0


def put_marker(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing one of the same name."""
    place, fs = _path(spark, path)
    out = fs.create(place, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all below it, if it is there."""
    place, fs = _path(spark, path)
    fs.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Paths right below a folder, none if there is no such folder."""
    place, fs = _path(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(place)] if fs.exists(place) else []
