"""Digests of files of any size, and the digest that stores give objects uploaded in parts.

A file is read by splits as lines, and where a line lies in its file is told by the bytes of the
splits before, a row a split. Lines become chunks of bounded size with their place. Parts of fixed
size are digested in parallel, and their digests combined in order. A plain digest has one state
from the first byte to the last, so the chunks of a file go to one task, in order: that task holds
one chunk at a time, however large the file.

A line is one value, so a stretch of 2 GB without a line feed cannot be read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of a chunk, and of a part of an object uploaded in parts.
CHUNK_BYTES, PART_BYTES = 1 << 20, 8 << 20
_CHUNKS = "path string, size long, part long, at long, data binary"


def chunks(spark: SparkSession, path: str | list[str], part_bytes: int) -> DataFrame:
    """``path, size, part, at, data``: the bytes of files, cut at least where a part ends."""
    read = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    lines = read.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").cast("binary").alias("data"),
    )
    splits = lines.groupBy("path", "block").agg(F.sum(F.octet_length("data") + 1).alias("bytes"))
    order = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("path", "block", F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("start"))
    placed = lines.join(F.broadcast(starts), ["path", "block"])  # a row a split; keeps the order
    names = [n.split()[0] for n in _CHUNKS.split(", ")]
    most = CHUNK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, size, at, held, length = None, 0, 0, [], 0

        def pieces(last: bool):
            """Chunks of what is held, whole ones or all; there is no line feed after the last line."""
            nonlocal at, held, length
            data = b"".join(held)
            if last:
                data = data[: max(0, size - at)]
            while data and (last or len(data) >= most):
                take = min(most, part_bytes - at % part_bytes, len(data))
                columns = [[place[0]], [size], [at // part_bytes], [at], [data[:take]]]
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )
                at += take
                data = data[take:]
            held, length = ([data], len(data)) if data else ([], 0)

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for path, block, whole, line, start in zip(*columns, strict=True):
                if (path, block) != place:
                    if place is not None:
                        yield from pieces(True)
                    place, size, at, held, length = (path, block), whole, start, [], 0
                held += (line, b"\n")
                length += len(line) + 1
                if length >= 2 * most:
                    yield from pieces(False)
        if place is not None:
            yield from pieces(True)

    return placed.select("path", "block", "size", "data", "start").mapInArrow(run, _CHUNKS)


def _streamed(cut: DataFrame, by: list[str], names: tuple[str, ...]) -> DataFrame:
    """``by, size`` and hex digests of the chunks of each group in their order, one chunk at a time."""
    columns = [*by, "size", *names]
    kinds = {"path": pa.string(), "part": pa.int64(), "size": pa.int64()}
    types = [kinds.get(c, pa.string()) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size, states = None, 0, []

        def row():
            values = [*group, size, *(s.hexdigest() for s in states)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types, strict=True)], names=columns
            )

        for batch in batches:
            own = [batch.column(c).to_pylist() for c in by]
            for i, data in enumerate(batch.column("data")):
                here = tuple(c[i] for c in own)
                if here != group:
                    if group is not None:
                        yield row()
                    group, size = here, batch.column("size")[i].as_py()
                    states = [hashlib.new(n) for n in names]
                for state in states:
                    state.update(data.as_buffer())
        if group is not None:
            yield row()

    kinds_sql = {"part": "long", "size": "long"}
    schema = ", ".join(f"{c} {kinds_sql.get(c, 'string')}" for c in columns)
    dealt = cut.repartition(*by).sortWithinPartitions(*by, "at")
    return dealt.mapInArrow(run, schema)


def streamed_digests(
    spark: SparkSession, path: str | list[str], names: tuple[str, ...] = ("md5", "sha1", "sha256")
) -> DataFrame:
    """``path, size`` and the hex digests of files of any size; files without bytes give no row."""
    return _streamed(chunks(spark, path, 1 << 62), ["path"], names)


def part_etags(spark: SparkSession, path: str | list[str], part_bytes: int = PART_BYTES) -> DataFrame:
    """``path, size, parts, etag`` as stores tell them of objects uploaded in parts of that size.

    That is the MD5 of the parts' MD5 digests in order, with their number; of one part alone it is
    the plain MD5, as of an object uploaded at once.
    """
    parts = _streamed(chunks(spark, path, part_bytes), ["path", "part"], ("md5",))
    each = parts.groupBy("path", "size").agg(
        F.count(F.lit(1)).alias("parts"), F.sort_array(F.collect_list(F.struct("part", "md5"))).alias("own")
    )
    digests = F.transform("own", lambda p: p["md5"])
    combined = F.concat_ws("-", F.md5(F.unhex(F.array_join(digests, ""))), F.col("parts").cast("string"))
    etag = F.when(F.col("parts") == 1, digests[0]).otherwise(combined)
    return each.select("path", "size", "parts", etag.alias("etag"))
