"""Sizes, value ranges and pruning of tables, and plain reports over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIB = 1024 * 1024


def table_stats(files: DataFrame, changes: DataFrame | None = None, table: str = "table_name") -> DataFrame:
    """Bytes and files per table from a file inventory, and versions from a change log."""
    sizes = files.groupBy(table).agg(
        F.sum("size").alias("total_size_bytes"), F.count(F.lit(1)).alias("file_count")
    )
    if changes is None:
        return sizes
    versions = (
        changes.select(table, "version").distinct().groupBy(table).agg(F.count(F.lit(1)).alias("snapshot_count"))
    )
    return sizes.join(versions, table, "left").fillna(0, ["snapshot_count"])


def partition_stats(files: DataFrame, partition: Column) -> DataFrame:
    """Files, bytes and mean size in MiB per partition value, largest first."""
    total = F.sum("size")
    return (
        files.groupBy(partition.alias("partition_value"))
        .agg(
            F.count(F.lit(1)).alias("file_count"),
            total.alias("total_size_bytes"),
            (total / F.count(F.lit(1)) / MIB).alias("avg_file_size_mb"),
        )
        .orderBy(F.desc("total_size_bytes"), "partition_value")
    )


def value_ranges(df: DataFrame, file: Column, columns: Sequence[str]) -> DataFrame:
    """Rows and the least and greatest value of each column per file."""
    ranges = [f(c).alias(f"{p}_{c}") for c in columns for f, p in ((F.min, "min"), (F.max, "max"))]
    return df.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("record_count"), *ranges)


def may_contain(column: str, low: Column | None = None, high: Column | None = None) -> Column:
    """Whether the range of a file can hold values from ``low`` to ``high``."""
    test = F.lit(True)
    if low is not None:
        test = test & (F.col(f"max_{column}") >= low)
    if high is not None:
        test = test & (F.col(f"min_{column}") <= high)
    return F.coalesce(test, F.lit(False))


def scan_efficiency(ranges: DataFrame, table: Column, needed: Column) -> DataFrame:
    """Files a predicate has to read, of all files, per table."""
    counted = ranges.groupBy(table.alias("table_name")).agg(
        F.count_if(needed).alias("files_scanned"), F.count(F.lit(1)).alias("files_total")
    )
    share = F.col("files_scanned").cast("double") / F.col("files_total").cast("double") * 100
    return counted.withColumn("scan_efficiency_pct", share)


def top(df: DataFrame, n: int, by: str, *tie: str) -> DataFrame:
    """The ``n`` rows with the greatest ``by``; each task keeps only its own ``n``."""
    return df.orderBy(F.desc(by), *tie).limit(n)


def top_per_group(df: DataFrame, group: Sequence[str], n: int, by: str, *tie: str) -> DataFrame:
    """The ``n`` first rows of each group with their rank ``rn``.

    Spark cuts each group to ``n`` rows within every task before the shuffle, so a group with
    very many rows costs no more than another.
    """
    ranked = Window.partitionBy(*group).orderBy(F.desc(by), *tie)
    return df.withColumn("rn", F.row_number().over(ranked)).filter(F.col("rn") <= n)


def count_and_mean(df: DataFrame, group: Sequence[str], value: str, count: str, mean: str) -> DataFrame:
    """Rows and mean per group; summed as decimals, so the order of rows does not show."""
    total = F.sum(F.col(value).cast("decimal(18,2)")).cast("double")
    rows = F.count(value)
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(count), (total / rows).alias(mean))


def hourly(events: DataFrame, time: str = "ts", kind: str = "event_type", hours: int = 1) -> DataFrame:
    """Events per window of whole hours and type; works on batches and on streams."""
    return (
        events.groupBy(F.window(time, f"{hours} hour").alias("w"), kind)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("window_start"), kind, "events")
    )
