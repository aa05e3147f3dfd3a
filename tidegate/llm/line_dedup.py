"""Repeated lines across documents, as bitmaps of the lines that each document keeps.

Hashes of lines are dealt by ranges of (hash, document, line) and sorted within each range, so a
line that a third of all documents hold is spread over many tasks, by document. A task streams
over its range and keeps the first document of each hash. Only the hash at the start of a range
may have begun in an earlier one; its rows wait for the smallest document of that hash, which the
first and last hashes of all ranges tell. What comes out are line numbers to drop, and of those a
compressed bitmap per document; texts do not take part before the bitmaps are applied.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

from tidegate.llm import common

#: Code points from which a line counts.
LEAST_POINTS = 10
_SPACE = b" \t\n\x0b\x0c\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _binary(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def line_keys(text: bytes, least: int = LEAST_POINTS) -> tuple[list[int], list[bytes]]:
    """Numbers and 128-bit hashes of the lines that count: stripped, A-Z in lower case."""
    import xxhash

    numbers, hashes = [], []
    for i, line in enumerate(text.translate(_FOLD).split(b"\n")):
        line = line.strip(_SPACE)
        size = len(line)
        if size >= least and (size >= 4 * least or len(line.decode("utf-8", "replace")) >= least):
            numbers.append(i)
            hashes.append(xxhash.xxh3_128_digest(line))
    return numbers, hashes


def _hashed(schema: StructType, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, hashes, counts = [], [], []
            for text in _binary(batch.column(2)):
                found, digests = line_keys(text, least)
                numbers += found
                hashes += digests
                counts.append(len(found))
            halves = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0].copy()),
                    pa.array(halves[:, 1].copy()),
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(numbers, pa.int32()),
                ],
                names=schema.fieldNames(),
            )

    return run


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; null equals null."""
    one, other = column.slice(1), column.slice(0, len(column) - 1)
    differ = pc.fill_null(pc.not_equal(one, other), False)
    return pc.or_(differ, pc.xor(one.is_null(), other.is_null())).to_numpy(zero_copy_only=False)


def _first_documents(schema: StructType):
    """Streams a sorted range: lines of later documents, all of the first hash, and the last hash.

    Rows with a hash are open: those of the range's first hash, which may have begun before, and
    one without a line for the first document of its last hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before, as a batch
        leading, in_first, opened = True, True, None
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = pa.Table.from_batches([last, batch] if last else [batch]).combine_chunks()
            columns = [c.chunk(0) for c in seen.columns]
            new_hash = _changes(columns[0]) | _changes(columns[1])
            new_key = new_hash | _changes(columns[2])
            if last is None:
                new_hash = np.concatenate(([True], new_hash))
                new_key = np.concatenate(([True], new_key))
            places = np.arange(batch.num_rows)
            began = np.maximum.accumulate(np.where(new_hash, places, -1))
            turned = np.maximum.accumulate(np.where(new_key, places, -1))
            # -1: still the hash of the batch before, whose document may have turned already
            first = np.where(began >= 0, turned == began, in_first & (turned < 0))
            later = np.flatnonzero(new_hash)[1 if last is None else 0 :]
            ends_leading = int(later[0]) if leading and len(later) else batch.num_rows
            lead = places < ends_leading if leading else np.zeros(batch.num_rows, dtype=bool)
            none = pa.nulls(batch.num_rows, pa.int64())
            yield batch.filter(pa.array(lead))
            closed = pa.RecordBatch.from_arrays([none, none, *batch.columns[2:]], schema=batch.schema)
            yield closed.filter(pa.array(~lead & ~first))
            if len(later):
                leading = False
                opened = batch.slice(int(later[-1]), 1)
            in_first = bool(first[-1])
            last = batch.slice(batch.num_rows - 1)
        if opened is not None:
            empty = [pa.nulls(1, opened.schema.field(i).type) for i in (3, 4)]
            yield pa.RecordBatch.from_arrays([*opened.columns[:3], *empty], schema=opened.schema)

    return run


def _packed_bits(schema: StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, packed = batch.column(2), []
            for numbers in lists:
                gone = np.asarray(numbers.values.to_numpy(zero_copy_only=False), dtype=np.int64)
                keep = np.ones((int(gone.max()) // 8 + 1) * 8, dtype=np.uint8)
                keep[gone] = 0
                packed.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pc.list_value_length(lists).cast(pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=schema.fieldNames(),
            )

    return run


def keep_bitmaps(df: DataFrame, key: str, text: str, least: int = LEAST_POINTS) -> DataFrame:
    """``key, mark, n_dropped, keep`` of each document that loses lines.

    A line, without white space at its ends and with A-Z in lower case, of ``least`` code points
    or more, is dropped from each document but the one with the smallest key that holds it; there
    all its repeats stay. ``keep`` has a bit per line, least significant first, up to the last
    dropped one, compressed with zlib; lines beyond stay. ``mark`` is the hash of the text: rows
    with equal keys are one document, whose lines all stay if its key is the smallest, and each
    different text of it has a bitmap of its own. A row without a key comes after all keys. Null
    and empty texts, and an empty table, give no rows. Other columns of ``df`` are not read.
    """
    common.prepare_workers(df.sparkSession)
    kind = df.schema[key]
    texts = df.select(F.col(key).alias("k"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("t"))
    schema = (
        StructType()
        .add("h1", LongType())
        .add("h2", LongType())
        .add("k", kind.dataType)
        .add("mark", LongType())
        .add("line", IntegerType())
    )
    lines = texts.where(F.length("t") >= least).mapInArrow(_hashed(schema, least), schema)
    order = ["h1", "h2", F.col("k").asc_nulls_last(), "mark", "line"]
    ranges = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    found = common.written(ranges.mapInArrow(_first_documents(schema), schema), "later-lines")

    opened = found.where("h1 is not null")
    smallest = opened.groupBy("h1", "h2").agg(F.min("k").alias("smallest"))
    smallest = F.broadcast(smallest.where("smallest is not null"))  # two rows a range at most
    later = F.col("k").isNull() | (F.col("k") > F.col("smallest"))
    waited = opened.where("line is not null").join(smallest, ["h1", "h2"]).where(later)
    gone = found.where("h1 is null").select("k", "mark", "line")
    gone = gone.union(waited.select("k", "mark", "line"))
    each = gone.groupBy("k", "mark").agg(F.collect_set("line").alias("lines"))
    schema = StructType().add("k", kind.dataType).add("mark", LongType())
    schema = schema.add("n_dropped", LongType()).add("keep", BinaryType())
    bitmaps = each.mapInArrow(_packed_bits(schema), schema)
    return bitmaps.withColumnRenamed("k", key)


def kept_lines(text: bytes, keep: bytes | None) -> tuple[int, bytes]:
    """How many lines a text has, and the text of the lines that a bitmap keeps."""
    if keep is None:
        return text.count(b"\n") + 1, text
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    bits = np.concatenate((bits[: len(lines)], np.ones(max(0, len(lines) - len(bits)), np.uint8)))
    return len(lines), b"\n".join([line for line, bit in zip(lines, bits.tolist(), strict=True) if bit])


def with_kept_lines(df: DataFrame, key: str, text: str, bitmaps: DataFrame) -> DataFrame:
    """``key, n_lines, n_dropped, kept`` of each row: ``kept`` is its text without dropped lines.

    Texts meet their bitmaps by key and hash of the text; rows without a bitmap keep all lines,
    and null texts count as one empty line.
    """
    common.prepare_workers(df.sparkSession)
    kind = df.schema[key]
    texts = df.select(F.col(key).alias("k"), F.xxhash64(F.col(text)).alias("m"), F.col(text).alias("t"))
    same = F.col("k").eqNullSafe(F.col(key)) & (F.col("m") == F.col("mark"))
    met = texts.join(bitmaps.select(key, "mark", "n_dropped", "keep"), same, "left")
    met = met.select("k", "t", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n"), "keep")
    schema = StructType().add("k", kind.dataType).add("n_lines", LongType())
    schema = schema.add("n_dropped", LongType()).add("kept", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keeps = batch.column(3).to_pylist()
            found = [kept_lines(t, k) for t, k in zip(_binary(batch.column(1)), keeps, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _ in found], pa.int64()),
                    batch.column(2),
                    pa.array([t for _, t in found], pa.binary()).cast(pa.string()),
                ],
                names=schema.fieldNames(),
            )

    return met.mapInArrow(run, schema).withColumnRenamed("k", key)
