"""What several operators share."""

from __future__ import annotations

import shutil
import tempfile
import zlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import work_folder
from tidegate.sources import hadoop

#: Rows that go to a Python worker at once: long texts make larger batches than Spark expects.
BATCH_ROWS = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_shipped: set[str] = set()


def prepare_workers(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch (a lower setting stays), and send workers this package.

    The package goes through Spark's own distribution of Python files, once per application.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId not in _shipped and package.is_dir():
        place = tempfile.mkdtemp(prefix="package-")  # on the driver, from where Spark copies it
        archive = f"{place}/{package.name}"
        context.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


_scratch: list[list[str]] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and no lost executor takes it away."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    if _scratch:
        _scratch[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without_scratch(df: Callable[[], DataFrame], spark: SparkSession, label: str) -> DataFrame:
    """What ``df`` makes, as a table; tables :func:`written` on the way are removed after that."""
    _scratch.append([])
    try:
        made = df()
        path = work_folder(spark, label)
        made.write.parquet(path)
        schema = made.schema
    finally:
        for old in _scratch.pop():
            hadoop.remove(spark, old)
    if _scratch:
        _scratch[-1].append(path)
    return spark.read.schema(schema).parquet(path)


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def is_held_out(key: int) -> bool:
    return zlib.crc32(str(key).encode()) % 5 == 0


def training_sample(
    documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int, chars: int
) -> list[tuple[str, int]]:
    """Texts and labels to learn from, in a fixed order; never of held-out rows.

    At most ``rows`` rows, those with the smallest hashes of their keys, and no text beyond
    ``chars`` characters, so that the driver can hold them. Of a repeated key the smallest text
    counts, whichever task holds it, so repeats never reach the driver. Rows without a key, text or
    label are left out. Only the key, the text and the label are read.
    """
    usable = F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key))
    chosen = labels.where(usable).select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    chosen = chosen.groupBy("__key").agg(F.max("__label").alias("__label"))
    chosen = chosen.orderBy(F.xxhash64("__key"), "__key").limit(rows)
    texts = documents.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    texts = texts.where(F.length("__text") <= chars)
    found = texts.join(F.broadcast(chosen), "__key")  # at most ``rows`` rows
    found = found.groupBy("__key", F.col("__label").cast("int").alias("__label"))
    out = found.agg(F.min("__text").alias("__text")).select("__key", "__text", "__label").collect()
    return [(r["__text"], r["__label"]) for r in sorted(out)]


def decided(scored: DataFrame, key: str, least: float) -> DataFrame:
    """``key, held_out, score, predicted``."""
    return scored.select(
        key,
        held_out(F.col(key)).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )
