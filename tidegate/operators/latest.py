"""Latest row per key and previous row per key, with no hot key bound to one task."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.values import micros

# How finely work may be cut up. None of these bounds the rows that are handled.
MAX_SLICES = 1_000
SAMPLES_PER_SLICE = 16
SKETCH_ITEMS = 10_000
SKETCH_ITEMS_PER_PIECE = 16


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row with the greatest ``order`` of each key.

    An aggregate, not a window: every task first reduces its own rows to one per key, so a
    key with very many rows shuffles no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def time_micros(df: DataFrame, column: str) -> Column:
    """Microseconds of a timestamp column of either kind."""
    return micros(F.col(column), isinstance(df.schema[column].dataType, T.TimestampType))


def hot_keys(df: DataFrame, keys: Sequence[str], pieces: int) -> list[int]:
    """Hashes of the keys that hold more than one part in ``pieces`` of all rows.

    There are at most ``pieces`` of them. A sketch counts them in one scan of the key columns,
    without a shuffle. It decides how work is cut up, never what comes out.
    """
    tracked = max(SKETCH_ITEMS, SKETCH_ITEMS_PER_PIECE * pieces)
    found = (
        df.select(F.xxhash64(*keys).alias("_hash"))
        .agg(F.expr(f"approx_top_k(_hash, {pieces}, {tracked})").alias("top"), F.count(F.lit(1)).alias("rows"))
        .first()
    )
    return [t["item"] for t in found["top"] or [] if t["count"] * pieces > found["rows"]]


def _bounds(hot_rows: DataFrame, sort: Sequence[str], slices: int, block: int) -> DataFrame:
    """One row: sort tuples that cut ``hot_rows`` into about ``slices`` equal parts (``fine``), and
    the last of each ``block`` of them (``coarse``).

    They come from a sample of fixed size, the rows with the smallest hashes, so the same rows give
    the same bounds however often this runs.
    """
    hashed = [f.name for f in hot_rows.schema if not re.search("map<|variant", f.dataType.simpleString())]
    rows = hot_rows.select(F.struct(*sort).alias("at"), F.xxhash64(*hashed).alias("hash"))
    sample = rows.orderBy("hash", "at").limit(SAMPLES_PER_SLICE * slices)
    every = F.greatest(F.ceil(F.size("all") / slices).cast("int"), F.lit(1))
    inner = F.array_distinct(F.filter("all", lambda _, i: (i > 0) & (i % F.col("every") == 0)))
    fine = (
        sample.agg(F.array_sort(F.collect_list("at")).alias("all"))
        .withColumn("every", every)
        .select(inner.alias("fine"))
    )
    coarse = F.filter("fine", lambda _, i: i % block == block - 1)
    return fine.select(F.struct(coarse.alias("coarse"), "fine"))


def _sliced(df: DataFrame, keys: Sequence[str], sort: Sequence[str], hot: list[int], slices: int) -> DataFrame:
    """``df`` with ``_slice``, 0 for most rows.

    Rows of hot keys are cut by the whole of ``sort`` into slices of about equal size, numbered
    upwards, so rows of one time or of a text order are cut like others. Only rows that are equal in
    all of ``sort`` stay together. A row finds its slice in two steps, among the bounds of blocks
    and within one block.
    """
    is_hot = F.xxhash64(*keys).isin(hot)
    block = max(1, round(slices**0.5))
    bounds = _bounds(df.where(is_hot), sort, slices, block).scalar()
    at = F.struct(*sort)

    def passed(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= F.col("_cut_at")))

    blocks = passed(F.col("_cut_bounds")["coarse"]) * block
    within = passed(F.slice(F.col("_cut_bounds")["fine"], blocks + 1, F.lit(block)))
    marked = df.withColumns({"_cut_at": F.when(is_hot, at), "_cut_bounds": F.when(is_hot, bounds)})
    number = F.when(F.col("_cut_at").isNotNull(), blocks + within).otherwise(0)
    return marked.withColumn("_slice", number).drop("_cut_at", "_cut_bounds")


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    name: str,
    tie: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """``df`` with ``name``: ``value`` of the row before within the same key.

    A plain ``lag`` puts all rows of a key into one task, which is fine unless a key holds much
    of the table. Such keys are looked for first. Without any, the plain ``lag`` it is. With
    some, their rows are cut by ``order`` and ``tie`` into slices, so that no window holds more than
    about one slice. Only the first row of a hot key in a slice looks further back: it takes the last
    value of the key in an earlier slice, from a summary of one row per hot key and slice.

    ``slices`` defaults to the shuffle partitions of the session; 1 asks for the plain window. Any
    types that sort will do. Nulls come first.
    """
    conf = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = min(conf if slices is None else slices, MAX_SLICES)
    sort = [order, *tie]
    hot = hot_keys(df, keys, count) if count > 1 else []
    if not hot:
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(*sort)))
    cut = _sliced(df, keys, sort, hot, count)
    place = [*keys, "_slice"]
    ends = (
        cut.filter(F.xxhash64(*keys).isin(hot))
        .groupBy(*place)
        .agg(F.max_by(F.struct(F.col(value).alias("value")), F.struct(*sort)).alias("_end"))
    )
    before = F.lag("_end").over(Window.partitionBy(*keys).orderBy("_slice"))
    carried = ends.select(*(F.col(c).alias(f"_at_{c}") for c in place), before["value"].alias("_carried"))
    inside = Window.partitionBy(*place).orderBy(*sort)
    # Null keys are keys too.
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in place))
    # A value before may be null, so the place of the row decides, not what was found.
    opens = F.col("_row") == 1
    return (
        cut.withColumns({"_inside": F.lag(value).over(inside), "_row": F.row_number().over(inside)})
        .join(carried, same, "left")
        .select(*df.columns, F.when(opens, F.col("_carried")).otherwise(F.col("_inside")).alias(name))
    )
