"""What changed between two snapshots of a table, and a snapshot with changes laid over it.

Rows are dealt into buckets by the hash of their key. Each snapshot adds up the hashes of its rows
per bucket, within each task before the shuffle, so that equal buckets are told from a few numbers.
Only rows of buckets that differ go on to the comparison by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of keys; their sums are all that is kept of equal ones. Rows of one change in a bucket
#: bring all of its rows along, so there are many.
BUCKETS = 65_536
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def _row_hash(columns: Sequence[str], salt: int) -> Column:
    # a null must not hash like the value before it, as Spark's hash passes over nulls
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(salt), *parts)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_sums(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, rows, sum0, sum1``: two sums of row hashes that do not depend on any order."""
    sums = [
        F.sum(_row_hash(df.columns, salt).cast("decimal(38,0)")).alias(f"sum{salt}") for salt in (0, 1)
    ]
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), *sums)


def changed_buckets(
    before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Buckets whose rows differ: ``buckets`` of them at most."""
    one, other = (bucket_sums(d, keys, buckets) for d in (before, after))
    same = reduce(Column.__and__, (one[c].eqNullSafe(other[c]) for c in ("rows", "sum0", "sum1")))
    met = one.join(other, one["bucket"] == other["bucket"], "full")
    bucket = F.coalesce(one["bucket"], other["bucket"]).alias("bucket")
    return met.where(~same).select(bucket)


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows that were inserted, updated or deleted, with ``change`` before the columns.

    Updated rows are as they are after, deleted ones as they were. Keys must be unique and not
    null in either snapshot, and both have the same columns. Values compare as Spark hashes and
    compares them; a value of another type is another column.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("snapshots have different columns")
    columns = before.columns
    wanted = F.broadcast(changed_buckets(before, after, keys, buckets))
    place = _bucket(keys, buckets).alias("bucket")
    old, new = (
        d.select(*columns, place).join(wanted, "bucket", "left_semi").select(*columns, F.lit(True).alias("_there"))
        for d in (before, after)
    )
    on = reduce(Column.__and__, (F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys))
    met = old.alias("old").join(new.alias("new"), on, "full")
    equal = reduce(
        Column.__and__, (F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in columns)
    )
    gone, added = F.col("new._there").isNull(), F.col("old._there").isNull()
    change = F.when(added, INSERT).when(gone, DELETE).when(~equal, UPDATE)
    values = (F.when(gone, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in columns)
    return met.select(change.alias("change"), *values).where("change is not null")


def applied(snapshot: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot after the changes: rows of changed keys go, inserted and updated ones come.

    Adaptive execution may broadcast changes that it measures to be few, so that the snapshot is
    not shuffled. Applying the same changes twice gives the same.
    """
    kept = snapshot.join(changed.select(*keys), list(keys), "left_anti").select(*snapshot.columns)
    return kept.unionByName(changed.where(F.col("change") != DELETE).select(*snapshot.columns))
