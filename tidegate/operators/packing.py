"""Small files packed into bins of a wanted size, and row caps told by bytes.

What goes together is decided from the listing alone, by first fit in order of falling size; rows of
other files are not read. Files that are not small stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.operators.tables import TARGET_FILE_BYTES
from tidegate.operators.zones import MOST_FILES
from tidegate.session import work_folder
from tidegate.sinks import files as sink
from tidegate.sources.inventory import FILE_PATH, file_rows

#: Files of one partition value that are packed at once; more are dealt into groups of about that.
GROUP_FILES = 20_000
#: Folder beside packed files with the paths that they took the place of; readers do not see it.
PACKED = "_packed"


def first_fit(sizes: np.ndarray, target: int) -> np.ndarray:
    """Bin of each size, in order of falling size: the first bin with room, by a tree of most room."""
    width = 1 << max(0, len(sizes) - 1).bit_length()
    room = np.full(2 * width, target, dtype=np.int64)
    bins = np.empty(len(sizes), dtype=np.int32)
    for place in np.argsort(-sizes, kind="stable"):
        size, node = min(int(sizes[place]), target), 1
        while node < width:
            node *= 2
            if room[node] < size:
                node += 1
        bins[place] = node - width
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins


def small_below(target_bytes: int) -> int:
    """Files below half of the target are small: any two of them fit into one bin."""
    return target_bytes // 2


def bins(
    files: DataFrame,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    group_files: int = GROUP_FILES,
) -> DataFrame:
    """``path, length, bin`` of the small ones of ``files`` (path, length and partition columns).

    Bins hold files of one partition value and at most ``target_bytes``, and are numbered from 0
    without gaps. Of each group of ``group_files`` files all bins but one are more than half full,
    as two bins that are not would have been one. A bin with one file would only copy it and is left
    out, which is one file of a group at most.
    """
    value = F.to_json(F.struct(*partition_by)) if partition_by else F.lit("")
    small = files.where(F.col("length") < small_below(target_bytes)).select("path", "length", value.alias("_value"))
    counted = small.groupBy("_value").agg(F.ceil(F.count(F.lit(1)) / group_files).alias("_groups"))
    group = F.pmod(F.xxhash64("path"), F.col("_groups")).cast("int")
    rows = small.join(counted, "_value").select("path", "length", "_value", group.alias("_group"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "path"], ascending=[False, True])
        rows["_bin"] = first_fit(rows["length"].to_numpy(), target_bytes)
        rows = rows[rows["_bin"].duplicated(keep=False)]
        return rows.assign(_bin=np.unique(rows["_bin"], return_inverse=True)[1])

    packed = rows.groupBy("_value", "_group").applyInPandas(
        pack, "path STRING, length BIGINT, _value STRING, _group INT, _bin INT"
    )
    # Groups become ranges of numbers; a row per group, not per file, is ordered in one place.
    kept = work_folder(files.sparkSession, "bins")
    packed.write.parquet(kept)
    packed = files.sparkSession.read.parquet(kept)
    groups = packed.groupBy("_value", "_group").agg((F.max("_bin") + 1).alias("_bins"))
    before = Window.orderBy("_value", "_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.withColumn("_start", F.coalesce(F.sum("_bins").over(before), F.lit(0))).drop("_bins")
    numbered = packed.join(starts, ["_value", "_group"])
    return numbered.select("path", "length", (F.col("_start") + F.col("_bin")).cast("int").alias("bin"))


def pack_small(
    spark: SparkSession,
    path: str,
    new_path: str,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    min_files: int = 2,
    group_files: int = GROUP_FILES,
) -> bool:
    """Write the rows of the small files of a Parquet table into one file per bin below ``new_path``;
    tells whether there were ``min_files`` to pack.

    Only rows of these files are moved, each to the task of its bin. :func:`read_packed` reads the
    new files together with the others; the list of packed files is written last, and without it
    there is nothing to read.
    """
    listed = file_rows(spark, path).select(F.col(FILE_PATH).alias("path"), "length", *partition_by)
    packed = bins(listed, partition_by, target_bytes, group_files)
    stats = packed.agg(F.count(F.lit(1)), F.max("bin")).first()
    if stats[0] < min_files:
        return False
    table = spark.read.parquet(path)
    small = table.where(F.col("_metadata.file_size") < small_below(target_bytes))
    moved = small.select("*", F.col(FILE_PATH).alias("_file")).join(
        packed.select(F.col("path").alias("_file"), F.col("bin").alias("_bin")), "_file"
    )
    placed = moved.repartitionById(stats[1] + 1, "_bin").select(*table.columns)
    placed.write.mode("overwrite").partitionBy(*partition_by).parquet(new_path)
    packed.select("path").write.parquet(f"{new_path.rstrip('/')}/{PACKED}")
    return True


def read_packed(
    spark: SparkSession, path: str, new_path: str, target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """A table after :func:`pack_small`: new files, and those of before that were not packed.

    The scan leaves small files out by their size; the few that were not packed are read by name.
    """
    table = spark.read.parquet(path)
    large = F.col("_metadata.file_size") >= small_below(target_bytes)
    packed = spark.read.schema("path STRING").parquet(f"{new_path.rstrip('/')}/{PACKED}")
    listed = file_rows(spark, path).select(F.col(FILE_PATH).alias("path"), "length")
    left = listed.where(F.col("length") < small_below(target_bytes)).join(packed, "path", "left_anti")
    names = [r.path for r in left.select("path").limit(MOST_FILES + 1).collect()]
    kept = table.where(large).unionByName(spark.read.schema(table.schema).parquet(new_path))
    if not names:
        return kept
    if len(names) <= MOST_FILES:
        return kept.unionByName(spark.read.schema(table.schema).option("basePath", path).parquet(*names))
    others = table.where(~large).select("*", F.col(FILE_PATH).alias("path"))
    return kept.unionByName(others.join(packed, "path", "left_anti").select(*table.columns))


def bytes_per_row(spark: SparkSession, path: str) -> float | None:
    """Mean bytes of a row of a Parquet table, from its listing and footers; null without rows."""
    rows = spark.read.parquet(path).count()
    length = file_rows(spark, path).agg(F.sum("length")).first()[0]
    return length / rows if rows else None


def overwrite_by_bytes(
    df: DataFrame,
    path: str,
    target_bytes: int = TARGET_FILE_BYTES,
    like: str | None = None,
    partition_by: Sequence[str] = (),
) -> int | None:
    """Replace a table with files of at most about ``target_bytes``; gives the row cap that this took.

    The cap comes from the mean row of the table ``like`` (the one that is replaced, if it is there),
    without one there is no cap. Tasks may leave smaller files, for :func:`pack_small` to join.
    ``df`` must not read ``path``.
    """
    mean = bytes_per_row(df.sparkSession, like or path)
    rows = max(1, int(target_bytes / mean)) if mean else None
    sink.write(df, path, partition_by=partition_by, max_records_per_file=rows)
    return rows
