"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to integers. A block of rows keeps, for each component, one bitmap per bit
of its value above the block's smallest, without the lowest bits. A query adds the bitmaps,
weighted by the bits of its own components, with full adders over whole machine words; the sums
are slices too. Walking them from the most significant slice down finds the k-th largest sum, and
a second walk the rows whose sum comes so close to it that the bits left out could decide. Only
these boundary rows are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm import common

#: Rows of a block of the index, and queries that meet a block in one task.
BLOCK_ROWS, QUERY_ROWS = 16_384, 256
#: Groups of query blocks; each block of rows is dealt to each group.
MOST_GROUPS = 1024
#: Bits of a component that the slices leave out.
DROPPED_BITS = 2
#: Components from here on are scored without slices, and exactly.
WIDE = 1 << 20


def quantised(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``id, values``: floor(scale * x) of each component x as double.

    Rows without a key, and vectors that are null or hold null or non-finite components, are left
    out; a vector without components has the inner product zero with any other.
    """
    x = F.col(vector).cast("array<double>")
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)
    return rows.select(F.col(key).cast("long").alias("id"), scaled.alias("values"))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of integers, filled up with zeros to the longest."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(offsets)
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat[offsets[0] : offsets[-1]]
    return out


def _packed(name: str, rows: int):
    """Rows of a partition as blocks: their ids and values as bytes, and how many they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(part: pa.Table) -> pa.RecordBatch:
            merged = part.combine_chunks()
            values = _matrix(merged.column("values").chunk(0))
            ids = merged.column("id").to_numpy().astype("<i8")
            return pa.RecordBatch.from_pydict(
                {
                    f"{name}_ids": pa.array([ids.tobytes()], pa.binary()),
                    f"{name}_values": pa.array([values.astype("<i8").tobytes()], pa.binary()),
                    f"{name}_rows": pa.array([len(ids)], pa.int32()),
                }
            )

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= rows:
                whole = pa.Table.from_batches(held)
                yield block(whole.slice(0, rows))
                held = whole.slice(rows).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return run


def _blocks(df: DataFrame, name: str, rows: int) -> DataFrame:
    return df.mapInArrow(
        _packed(name, rows), f"{name}_ids binary, {name}_values binary, {name}_rows int"
    )


class Index:
    """The slices of a block of rows."""

    def __init__(self, values: np.ndarray):
        rows, width = values.shape
        self.values, self.rows, self.words = values, rows, -(-rows // 64)
        self.low = values.min(axis=0) if rows and width else np.zeros(width, np.int64)
        above = (values - self.low) >> DROPPED_BITS
        self.bits = int(above.max(initial=0)).bit_length()
        self.slices = np.zeros((2, width, self.bits, self.words), dtype=np.uint64)
        padded = np.zeros((width, self.words * 64), dtype=np.uint8)
        for b in range(self.bits):
            padded[:, :rows] = ((above >> b) & 1).T
            packed = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
            self.slices[0, :, b] = packed
            self.slices[1, :, b] = ~packed

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the sum of |q| times the quantised component, or its complement for q < 0."""
        size = np.abs(query)
        terms: dict[int, list[np.ndarray]] = {}
        for q in range(int(size.max(initial=0)).bit_length()):
            for sign in (0, 1):
                chosen = np.flatnonzero((size >> q & 1 == 1) & ((query < 0) == bool(sign)))
                if len(chosen):
                    for b in range(self.bits):
                        terms.setdefault(q + b, []).append(self.slices[sign, chosen, b])
        out: list[np.ndarray] = []
        weight = 0
        carried: list[np.ndarray] = []
        while weight <= max(terms, default=-1) or carried:
            rows = np.concatenate([*terms.get(weight, []), *carried] or [np.zeros((1, self.words), np.uint64)])
            carried = []
            while len(rows) > 1:
                third = len(rows) // 3
                if third:
                    a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
                    rest = rows[3 * third :]
                    half = a ^ b
                    carried.append((a & b) | (half & c))
                    rows = np.concatenate((half ^ c, rest)) if len(rest) else half ^ c
                else:
                    a, b = rows[:1], rows[1:]
                    carried.append(a & b)
                    rows = a ^ b
            out.append(rows[0])
            weight += 1
        return out

    def boundary(self, query: np.ndarray, k: int, valid: np.ndarray) -> np.ndarray:
        """Rows among ``valid`` that can be among the k best, by the slices."""
        sums = self.sums(query)
        sure, open_ = np.zeros(self.words, np.uint64), valid.copy()
        kth = 0
        for i in range(len(sums) - 1, -1, -1):
            ones = open_ & sums[i]
            if int(np.bitwise_count(sure | ones).sum()) >= k:
                open_, kth = ones, kth | 1 << i
            else:
                sure, open_ = sure | ones, open_ & ~sums[i]
        # the bits left out change a sum by less than |q| for each component
        least = max(0, kth - int(np.abs(query).sum()))
        above, equal = np.zeros(self.words, np.uint64), valid.copy()
        for i in range(len(sums) - 1, -1, -1):
            if least >> i & 1:
                equal = equal & sums[i]
            else:
                above, equal = above | (equal & sums[i]), equal & ~sums[i]
        found = np.unpackbits((above | equal).view(np.uint8), bitorder="little")
        return np.flatnonzero(found[: self.rows])


def _best(ids: np.ndarray, scores: list[int], k: int) -> list[tuple[int, int]]:
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k]
    return [(int(ids[i]), scores[i]) for i in order]


def block_top(
    ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> Iterator[tuple[int, int, int]]:
    """(query, id, score) of the k best rows of the block for each query."""
    width = max(values.shape[1], queries.shape[1])
    values = np.pad(values, ((0, 0), (0, width - values.shape[1])))
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    most = int(np.abs(values).max(initial=0)), int(np.abs(queries).max(initial=0))
    wide = max(most) >= WIDE or len(ids) <= 4 * k
    index = None if wide else Index(values)
    if index is not None:
        everyone = np.zeros(index.words * 64, dtype=np.uint8)
        everyone[: len(ids)] = 1
    exact = most[0] * most[1] * max(1, width) >= 1 << 62
    for query_id, query in zip(query_ids.tolist(), queries, strict=True):
        own = ids == query_id
        if index is None:
            rows = np.flatnonzero(~own)
        else:
            valid = everyone
            if own.any():
                valid = everyone.copy()
                valid[: len(ids)][own] = 0
            rows = index.boundary(query, k, np.packbits(valid, bitorder="little").view(np.uint64))
        if exact:
            found = [sum(a * b for a, b in zip(v, query.tolist())) for v in values[rows].tolist()]
            found = [max(-(1 << 63), min((1 << 63) - 1, s)) for s in found]
        else:
            found = (values[rows] @ query).tolist()
        for row_id, score in _best(ids[rows], found, k):
            yield query_id, row_id, score


def _score(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def array(cell, rows: int) -> np.ndarray:
            return np.frombuffer(cell.as_py(), "<i8").reshape(rows, -1)

        for batch in batches:
            c = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                rows, asked = c["row_rows"][i].as_py(), c["query_rows"][i].as_py()
                found = block_top(
                    array(c["row_ids"][i], rows)[:, 0],
                    array(c["row_values"][i], rows),
                    array(c["query_ids"][i], asked)[:, 0],
                    array(c["query_values"][i], asked),
                    k,
                )
                query, row, score = zip(*found, strict=True) if (found := list(found)) else ((),) * 3
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array(query, pa.int64()),
                        "id": pa.array(row, pa.int64()),
                        "score": pa.array(score, pa.int64()),
                    }
                )

    return run


def top_k(
    df: DataFrame, key: str, vector: str, queries: DataFrame, k: int = 5, scale: int = 256
) -> DataFrame:
    """``query_id, rank, id, score``: the k rows of ``df`` with the highest inner product.

    ``queries`` has the same columns. Ties go to the smaller id; rows with the query's id are its
    own and no candidates; fewer candidates than k give fewer rows. Shorter vectors count as
    filled up with zeros, repeated rows as rows of their own, and scores beyond a long as the
    largest one. Each block of rows meets each block of queries once; neither side is broadcast
    or gathered, and each meeting gives at most k rows for a query.
    """
    common.prepare_workers(df.sparkSession)
    rows = quantised(df, key, vector, scale)
    count = rows.count()
    blocks = max(1, -(-count // BLOCK_ROWS))
    packed = _blocks(rows.repartition(blocks, "id"), "row", BLOCK_ROWS)
    packed = common.written(packed, "bit-sliced")
    asked = _blocks(quantised(queries, key, vector, scale).coalesce(blocks), "query", QUERY_ROWS)
    asked = common.written(asked, "queries")
    groups = max(1, min(MOST_GROUPS, asked.count()))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("query_ids"), F.lit(groups)))
    each = F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")
    met = packed.withColumn("group", F.explode(each)).join(asked, "group")
    dealt = met.repartition(min(blocks * groups, 10_000), F.xxhash64("row_ids", "query_ids"))
    found = dealt.mapInArrow(_score(k), "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
