"""Operations on whole tables kept as plain files: upsert, append, as-of reads, compaction.

No operation changes files that it reads. Results go to a new path, and the caller moves to it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate import schemas
from tidegate.functions.partitioning import PartitionField, SortField, with_partitions
from tidegate.operators.latest import latest_per_key
from tidegate.sinks import files as sink
from tidegate.sources.inventory import file_rows

# File size that compaction aims for, and how many small files it takes.
TARGET_FILE_BYTES = 128 * 1024**2
MIN_INPUT_FILES = 2


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys that occur more than once."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return source.filter(present).groupBy(*keys).count().filter("count > 1")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    condition: Column | None = None,
    check_source: bool = True,
) -> DataFrame:
    """Target with ``source`` merged in by ``keys``.

    A matched row is replaced as a whole where ``condition`` holds (columns of the two sides
    are ``target.x`` and ``source.x``; default: always), else kept. Source rows without a match
    are added. Null keys match nothing. Source keys must be unique.

    Two joins instead of one full outer join: Spark can broadcast the source of either when it
    is measured small, so that the target is not shuffled, and can split a target key that
    holds many rows; it can do neither for a full outer join.
    """
    if check_source and not repeated_keys(source, keys).isEmpty():
        raise ValueError(f"merge source has more than one row for the same {', '.join(keys)}")
    columns = target.columns
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"merge source lacks columns: {', '.join(missing)}")
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"target.{key}") == F.col(f"source.{key}"))
    change = F.col("source._matched")
    if condition is not None:
        change = change & F.coalesce(condition, F.lit(False))
    marked = source.select(*columns).withColumn("_matched", F.lit(True))
    joined = target.alias("target").join(marked.alias("source"), on, "left")
    updated = joined.select(
        *(F.when(change, F.col(f"source.{c}")).otherwise(F.col(f"target.{c}")).alias(c) for c in columns)
    )
    hit = target.select(*keys).join(source.select(*keys), list(keys), "left_semi").distinct()
    added = source.select(*columns).join(hit, list(keys), "left_anti")
    return updated.unionByName(added)


def append_merging_schema(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts; a column that a part lacks is null there."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first


def append(df: DataFrame, path: str) -> None:
    """Add rows to a Parquet table; new columns are allowed (read with :func:`read_merged`)."""
    sink.write(df, path, mode="append")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose files may have different columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def files_for(total_bytes: int, target_bytes: int = TARGET_FILE_BYTES) -> int:
    return max(1, -(-total_bytes // target_bytes))


def overwrite_sized(df: DataFrame, path: str, rows_per_file: int, partition_by: Sequence[str] = ()) -> None:
    """Replace a table with files of a chosen size, in the one write that is needed anyway."""
    sink.write(df, path, partition_by=partition_by, max_records_per_file=rows_per_file)


def as_of(changes: DataFrame, keys: Sequence[str], at: Column, version: str = "version") -> DataFrame:
    """State of a change table at a time: last version per key committed by then."""
    return latest_per_key(changes.filter(F.col("committed_at") <= at), keys, version)


def snapshots(changes: DataFrame, version: str = "version") -> DataFrame:
    """One row per committed version with its rows and time."""
    return changes.groupBy(version).agg(
        F.min("committed_at").alias("committed_at"), F.count(F.lit(1)).alias("added_records")
    )


def ddl(schema: StructType) -> str:
    """Column list of a CREATE TABLE for a schema."""
    return schema.toDDL()


def create_table(
    df: DataFrame,
    name: str,
    path: str,
    partitions: Sequence[PartitionField] = (),
    sort: Sequence[SortField] = (),
    properties: dict[str, str] | None = None,
) -> bool:
    """Make a Parquet table from ``df`` unless it exists; tells whether it was made."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        return False
    spec = list(partitions)
    full = with_partitions(df, spec)
    names = [f.column_name for f in spec]
    placed = sink.gathered(full, names)
    if sort:
        lead = [F.col(n).asc_nulls_first() for n in names]
        placed = placed.sortWithinPartitions(*lead, *(s.column_order() for s in sort))
    writer = placed.write.format("parquet").option("path", path).options(**(properties or {}))
    if names:
        writer = writer.partitionBy(*names)
    writer.saveAsTable(name)
    return True


def add_columns(spark: SparkSession, name: str, columns: Sequence[tuple[str, str, str]]) -> None:
    """Add (name, type, comment) columns to a catalog table; old rows read as null."""
    parts = [f"`{c}` {kind} COMMENT '{_quoted(comment)}'" for c, kind, comment in columns]
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(parts)})")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def with_added_columns(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """``df`` with null columns of the given names and types, where it lacks them."""
    new = {c: F.lit(None).cast(kind) for c, kind in columns if c not in df.columns}
    return df.withColumns(new) if new else df


@dataclass(frozen=True)
class LoadResult:
    """Where a load put its rows, how many, and how long it took."""

    target_name: str
    loaded_path: str
    rejected_path: str
    loaded_records: int
    rejected_records: int
    load_duration_ms: int
    load_id: str

    def struct(self) -> Column:
        """As ``load_results`` of a record, for :func:`tracking.assemble`."""
        names = ("target_name", "loaded_records", "rejected_records", "load_duration_ms", "load_id")
        return F.struct(*(F.lit(getattr(self, n)).alias(n) for n in names)).cast(
            schemas.struct(schemas.LOAD_RESULTS)
        )


def load(df: DataFrame, target_name: str, path: str, load_id: str | None = None) -> LoadResult:
    """Add rows with a null ``reject_reason`` as loaded and the rest as rejected, in one pass.

    A load has a folder of its own below ``path``, named by its id, so loads add up and one that
    runs again with the same id replaces only itself. Counts come from the footers of the written
    files, so a task that ran twice is not counted twice.
    """
    started = time.monotonic()
    load_id = load_id or uuid.uuid4().hex
    own = f"{path}/load_id={quote(load_id, safe='')}"
    status = F.when(F.col("reject_reason").isNull(), F.lit("loaded")).otherwise(F.lit("rejected"))
    df.withColumn("load_status", status).write.mode("overwrite").partitionBy("load_status").parquet(own)
    read = df.sparkSession.read.schema(StructType([*df.schema.fields]).add("load_status", "string")).parquet(own)
    counts = {r.load_status: r["count"] for r in read.groupBy("load_status").count().collect()}
    return LoadResult(
        target_name,
        f"{own}/load_status=loaded",
        f"{own}/load_status=rejected",
        counts.get("loaded", 0),
        counts.get("rejected", 0),
        round(1000 * (time.monotonic() - started)),
        load_id,
    )


def compact(
    spark: SparkSession,
    path: str,
    new_path: str,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    min_files: int = MIN_INPUT_FILES,
) -> bool:
    """Rewrite a Parquet table into files of about ``target_bytes``; tells whether it did.

    Without partitions no row is shuffled: each task reads neighbouring files up to the target
    size and writes one. With partitions each value gets as many slots as its bytes need, so
    a value with a third of the table is written by many tasks.
    """
    table = spark.read.parquet(path)
    sizes = _sizes(spark, path, partition_by, target_bytes)
    small = sizes.agg(F.sum("small_files"), F.sum("bytes"), F.sum("files")).first()
    if (small[0] or 0) < min_files:
        return False
    if not partition_by:
        table.coalesce(files_for(small[1], target_bytes)).write.mode("overwrite").parquet(new_path)
        return True
    _dealt(table, sizes, partition_by, target_bytes).write.mode("overwrite").partitionBy(
        *partition_by
    ).parquet(new_path)
    return True


def _dealt(table: DataFrame, sizes: DataFrame, partition_by: Sequence[str], target_bytes: int) -> DataFrame:
    """Rows dealt to tasks, as many for each partition value as its ``bytes`` need; no task has rows
    of two values."""
    needed = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int")
    before = Window.orderBy(*partition_by).rowsBetween(Window.unboundedPreceding, -1)  # a row per value
    first = F.coalesce(F.sum("_slots").over(before), F.lit(0)).alias("_first")
    slots = sizes.select(*partition_by, needed.alias("_slots")).select("*", first)
    files = int(slots.agg(F.sum("_slots")).first()[0] or 1)
    match = reduce(Column.__and__, (table[c].eqNullSafe(slots[c]) for c in partition_by))
    # Rows take turns, so that copies of one row do not all meet in one file. The tasks of one
    # value follow those of the value before.
    turn = F.pmod(F.monotonically_increasing_id(), F.coalesce("_slots", F.lit(1)))
    place = (F.coalesce("_first", F.lit(0)) + turn).cast("int")
    return (
        table.join(slots, match, "left")
        .select(*(table[c] for c in table.columns), place.alias("_task"))
        .repartitionById(files, "_task")
        .drop("_task")
    )


def compact_small(
    spark: SparkSession,
    path: str,
    new_path: str,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
    min_files: int = MIN_INPUT_FILES,
) -> bool:
    """Rewrite only the files below ``target_bytes``, into ``new_path``; tells whether it did.

    Larger files are not read and stay where they are: :func:`read_compacted` reads them together
    with the new ones. Partition values with fewer than ``min_files`` small files are rewritten
    only along with others, which costs no more than those files.
    """
    sizes = _sizes(spark, path, partition_by, target_bytes)
    few = sizes.agg(F.sum("small_files"), F.sum("small_bytes")).first()
    if (few[0] or 0) < min_files:
        return False
    small = spark.read.parquet(path).filter(F.col("_metadata.file_size") < target_bytes)
    if not partition_by:
        small.coalesce(files_for(few[1], target_bytes)).write.mode("overwrite").parquet(new_path)
        return True
    wanted = sizes.filter("small_files > 0").select(*partition_by, F.col("small_bytes").alias("bytes"))
    _dealt(small, wanted, partition_by, target_bytes).write.mode("overwrite").partitionBy(
        *partition_by
    ).parquet(new_path)
    return True


def read_compacted(
    spark: SparkSession, path: str, new_path: str, target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """A table after :func:`compact_small`: its large files, and those that took the small ones' place."""
    large = spark.read.parquet(path).filter(F.col("_metadata.file_size") >= target_bytes)
    return large.unionByName(spark.read.schema(large.schema).parquet(new_path))


def _sizes(
    spark: SparkSession, path: str, partition_by: Sequence[str], target_bytes: int
) -> DataFrame:
    """Files and bytes per partition value, from the file listing alone."""
    small = F.col("length") < target_bytes
    return file_rows(spark, path).groupBy(*partition_by).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.count_if(small).alias("small_files"),
        F.sum(F.when(small, F.col("length")).otherwise(0)).alias("small_bytes"),
    )


def current_rows(base: DataFrame, changes: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """A base table with the newest change per key laid over it.

    Changes only ever get appended; the base is rewritten when it is worth it, not per batch.
    """
    newest = latest_per_key(changes, keys, version).select(*base.columns)
    return merge(base, newest, keys, check_source=False)
