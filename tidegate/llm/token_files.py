"""Token ids in Parquet files, for selective reads.

A file holds whole documents in ascending order of their key: the key, ``part`` (the place of the
file among the files), ``first`` (ids before the document in the file), ``n_tokens`` and
``tokens``, a list of integers. Ids are dictionary encoded, and packed as deltas where a
dictionary does not pay; row groups and pages are bounded, and Parquet's page index lets a
reader skip to the pages of some keys, or read the counts without any token.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from tidegate.llm import common
from tidegate.llm.bpe import share_file
from tidegate.llm.words import open_tokenizer, spaced_words


@dataclass(frozen=True)
class Layout:
    """Sizes of the files' parts, and their encoding."""

    row_group_bytes: int = 32 << 20
    page_bytes: int = 256 << 10
    page_rows: int = 2_000
    dictionary: bool = True
    codec: str = "zstd"

    def options(self) -> dict[str, str]:
        return {
            "parquet.writer.version": "PARQUET_2_0",  # integers without a dictionary are deltas
            "parquet.enable.dictionary": str(self.dictionary).lower(),
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            "compression": self.codec,
        }


_encoders: dict[int, object] = {}


def _encoder(shared):
    content = shared.value
    if hash(content) not in _encoders:
        _encoders.clear()
        _encoders[hash(content)] = spaced_words(open_tokenizer(content))
    return _encoders[hash(content)]


def write_tokens(
    df: DataFrame,
    key: str,
    text: str,
    tokenizer: str,
    path: str,
    end_id: int | None = None,
    layout: Layout = Layout(),
) -> None:
    """Encode each row's text and write the ids below ``path`` in ascending order of ``key``.

    ``end_id`` is put after each document. Null texts count as empty, rows without a key come
    first, and an empty table makes files without rows. Rows with equal keys come in the order of
    the hashes of their texts, and as many of them as there may be are dealt to several files.
    Texts are ordered before they are encoded, so that a text is encoded once and files are even.
    The files' own columns are named above, so the key may not be called like one of them.
    """
    spark = df.sparkSession
    common.prepare_workers(spark)
    shared = share_file(spark, tokenizer)
    if key in ("part", "first", "n_tokens", "tokens"):
        raise ValueError(f"the key may not be called {key}, like a column of the files")
    order = [F.col(key)]
    if not df.groupBy(key).count().where("count > 1").isEmpty():
        order += [F.xxhash64("__text"), F.length("__text")]  # else ranges are told by keys alone
    ordered = df.select(F.col(key), F.col(text).alias("__text"))
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = (
        StructType([df.schema[key]])
        .add("part", IntegerType())
        .add("first", LongType())
        .add("n_tokens", LongType())
        .add("tokens", ArrayType(IntegerType()))
    )
    end = np.array([] if end_id is None else [end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(shared), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = encoder.encode_bytes(texts)
            flat = np.frombuffer(b"".join([x for ids in found for x in (ids, end)]), dtype="<i4")
            counts = np.array([len(ids) + len(end) for ids in found], dtype=np.int64) // 4
            offsets = np.concatenate(([0], np.cumsum(counts)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(texts), part, dtype=np.int32)),
                    pa.array(before + offsets[:-1]),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat)),
                ],
                names=schema.fieldNames(),
            )
            before += int(offsets[-1])

    ordered.mapInArrow(run, schema).write.options(**layout.options()).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files, with ``start``: the ids of all documents before each.

    The ids of whole files come from the counts alone; the tokens are read only if selected.
    """
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before")
    )  # a row per file
    return (
        files.join(F.broadcast(starts), "part")
        .withColumn("start", F.col("before") + F.col("first"))
        .drop("before", "part", "first")
    )


def token_digests(read: DataFrame, tokens: str = "tokens", out: str = "ids_crc32") -> DataFrame:
    """Replace the ids by the crc32 of all of them as little-endian unsigned 32-bit integers."""
    place = read.columns.index(tokens)
    kept = [f for f in read.schema.fields if f.name != tokens]
    schema = StructType(kept).add(out, LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(place)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            offsets = lists.offsets.to_pylist()
            sums = [
                zlib.crc32(values[i:j].tobytes())
                for i, j in zip(offsets[:-1], offsets[1:], strict=True)
            ]
            columns = [c for i, c in enumerate(batch.columns) if i != place]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.int64())], names=schema.fieldNames()
            )

    common.prepare_workers(read.sparkSession)
    return read.mapInArrow(run, schema)
