"""Tables that know the least and greatest values of their files, and scans that open few of them.

The zones of a table are rows ``file, record_count, min_c, max_c`` beside its files, in a folder
that readers of the table do not see. They are made from the files after a write. A scan compares
them with the range it is asked for and opens only files that may hold it, and files without zones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.paths import location
from tidegate.operators import statistics
from tidegate.sinks import files as sink
from tidegate.sources import hadoop
from tidegate.sources.inventory import FILE_PATH, list_files

ZONES = "_zones"
#: Files that a scan names one by one; of more it reads the table, by the ranges in its files.
MOST_FILES = 20_000


def write_zoned(
    df: DataFrame, path: str, columns: Sequence[str], partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write ``df`` in ranges of the first of ``columns``, and the zones of all of them.

    Rows near each other in that column share files, which makes zones narrow. With partitions the
    values of a partition are gathered instead.
    """
    placed = df if partition_by else df.repartitionByRange(*columns)
    sink.write(placed.sortWithinPartitions(*columns) if not partition_by else placed, path,
               partition_by=partition_by, mode=mode)
    add_zones(df.sparkSession, path, columns)


def add_zones(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """Add zones for the files that have none; each run reads only those files, and few columns."""
    known = read_zones(spark, path)
    files = spark.read.parquet(path)
    if known is not None:
        same = location(F.col(FILE_PATH)) == location(known["file"])
        files = files.select("*", "_metadata").join(F.broadcast(known.select("file")), same, "left_anti")
        file = F.col("_metadata.file_path")
    else:
        file = F.col(FILE_PATH)
    ranges = statistics.value_ranges(files, file, columns)
    ranges.write.mode("append").parquet(f"{path.rstrip('/')}/{ZONES}")


def read_zones(spark: SparkSession, path: str) -> DataFrame | None:
    """The zones of a table, if it has any."""
    place = f"{path.rstrip('/')}/{ZONES}"
    return spark.read.parquet(place) if hadoop.matches(spark, place) else None


def needed_files(
    spark: SparkSession, path: str, column: str, low: Column | None = None, high: Column | None = None
) -> DataFrame:
    """``file, size, needed`` of each file of a table, for values of a column from low to high."""
    files = list_files(spark, path).select(F.col("path").alias("file"), "size")
    zones = read_zones(spark, path)
    if zones is None or f"min_{column}" not in zones.columns:
        return files.withColumn("needed", F.lit(True))
    zones = zones.withColumnRenamed("file", "_file")
    same = location(F.col("file")) == location(F.col("_file"))
    needed = F.col("_file").isNull() | statistics.may_contain(column, low, high)
    return files.join(zones, same, "left").select("file", "size", needed.alias("needed"))


def scan(
    spark: SparkSession, path: str, column: str, low: Column | None = None, high: Column | None = None
) -> DataFrame:
    """Rows of a table whose ``column`` is from ``low`` to ``high``; either may be missing.

    Only files that may hold such rows are opened.
    """
    table = spark.read.parquet(path)
    within = F.lit(True)
    if low is not None:
        within = within & (F.col(column) >= low)
    if high is not None:
        within = within & (F.col(column) <= high)
    wanted = needed_files(spark, path, column, low, high).where("needed").select("file")
    names = [r.file for r in wanted.limit(MOST_FILES + 1).collect()]
    if not names:
        return table.where(F.lit(False))
    if len(names) <= MOST_FILES:
        table = spark.read.schema(table.schema).option("basePath", path).parquet(*names)
    return table.where(within)
