"""Hard negatives: for an anchor and a positive, rows of other labels that score nearly as high.

Scores are integer inner products of quantised vectors. Anchors are dealt into groups, and each
group has a spanning tree of least total distance. With s(p) the score of a candidate at a parent
p, the score at a child c lies within distance(p, c) times the candidate's norm of s(p), and the
same holds for bounds in place of s(p). A block of candidates is scored exactly at the root of the
tree; then each child has bounds from its parent, and only candidates whose bounds overlap the
window that is asked for are scored again, exactly.

Positives come first: a window that reaches from the 5th best lower bound up. Negatives take
windows from the positives' scores. A block of candidates is read once for all groups of anchors:
groups are what is copied, a hundredth of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm import common

#: Candidates of a block, and anchors of a group with one spanning tree.
BLOCK_ROWS, GROUP_ROWS = 32_768, 512
#: Values from which on products could be inexact as doubles are computed as Python integers.
EXACT = 1 << 52
#: Scores beyond a long are given as this, or its negative.
MOST = (1 << 63) - 1


def _array(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, dtype="<i8").tobytes()


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of integers, filled up with zeros to the longest."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(offsets)
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat[offsets[0] : offsets[-1]]
    return out


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent of each vector (-1 for the first) and the distance to it, in a least spanning tree."""
    size = len(vectors)
    points = vectors.astype(np.float64)
    parent, best = np.full(size, -1, dtype=np.int64), np.full(size, np.inf)
    waiting, near, at = np.ones(size, dtype=bool), np.zeros(size, dtype=np.int64), 0
    edge = np.zeros(size)
    for _ in range(size - 1):
        waiting[at] = False
        distance = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        closer = waiting & (distance < best)
        best[closer], near[closer] = distance[closer], at
        at = int(np.argmin(np.where(waiting, best, np.inf)))
        parent[at], edge[at] = near[at], best[at]
    return parent, edge


def visits(parent: np.ndarray) -> Iterator[tuple[int, bool, bool]]:
    """The tree from its root down; whether a node is the last child, and whether it has any.

    Of a node's children that with most below it comes last, so that only as many nodes as the
    logarithm of the tree have to be remembered.
    """
    children: list[list[int]] = [[] for _ in parent]
    for child, above in enumerate(parent.tolist()):
        if above >= 0:
            children[above].append(child)
    roots = [i for i, above in enumerate(parent.tolist()) if above < 0]
    order, stack = [], roots[:]
    while stack:
        order.append(at := stack.pop())
        stack += children[at]
    below = np.ones(len(parent), dtype=np.int64)
    for at in reversed(order):
        if parent[at] >= 0:
            below[parent[at]] += below[at]
    waiting = [(r, True) for r in roots]
    while waiting:
        at, last = waiting.pop()
        yield at, last, bool(children[at])
        heaviest_first = sorted(children[at], key=lambda c: -below[c])
        waiting += [(c, i == 0) for i, c in enumerate(heaviest_first)]


class Candidates:
    """A block of rows, its norms, and exact scores of some of them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.values = ids[order], labels[order], values[order]
        self.floats = self.values.astype(np.float64)
        # a little more than the norm, so that rounding breaks no bound
        self.norms = np.sqrt((self.floats**2).sum(axis=1)) * (1 + 1e-9) + 1e-9
        self.largest = int(np.abs(self.floats).max(initial=0))
        self.members = {int(v): np.flatnonzero(self.labels == v) for v in np.unique(self.labels)}

    def inexact(self, anchors: np.ndarray) -> bool:
        """Whether scores may be too large for a double to hold."""
        most = int(np.abs(anchors.astype(np.float64)).max(initial=0))
        return self.largest * most * max(1, anchors.shape[-1]) >= EXACT

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        width = self.values.shape[1]
        anchor, extra = anchor[:width], np.zeros(max(0, width - len(anchor)), dtype=np.int64)
        anchor = np.concatenate((anchor, extra))
        if self.inexact(anchor):
            whole = anchor.tolist()
            found = [sum(a * b for a, b in zip(v, whole)) for v in self.values[rows].tolist()]
            return np.array([max(-MOST, min(MOST, s)) for s in found], dtype=np.int64)
        if len(rows) * 2 > len(self.floats):
            return np.rint(self.floats @ anchor)[rows].astype(np.int64)
        return np.rint(self.floats[rows] @ anchor).astype(np.int64)


class Bounds:
    """Lower and upper bounds of the scores of all candidates at one anchor."""

    def __init__(self, block: Candidates, low: np.ndarray, high: np.ndarray):
        self.block, self.low, self.high = block, low, high

    @classmethod
    def at_root(cls, block: Candidates, anchor: np.ndarray) -> Bounds:
        return cls(block, *_around(block.scores(anchor, np.arange(len(block.ids)))))

    @classmethod
    def open(cls, block: Candidates) -> Bounds:
        """No bounds, for scores that doubles do not hold."""
        return cls(block, np.full(len(block.ids), -np.inf), np.full(len(block.ids), np.inf))

    def below(self, edge: float) -> Bounds:
        """At a child; the edge's length counts a little longer."""
        slack = self.block.norms * (edge * (1 + 1e-9) + 1e-9)
        return Bounds(self.block, self.low - slack, self.high + slack)

    def settle(self, rows: np.ndarray, scores: np.ndarray) -> None:
        self.low[rows], self.high[rows] = _around(scores)


def _around(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds around scores, with room for rounding in sums of edges."""
    exact = scores.astype(np.float64)
    off = np.abs(exact) * 1e-12
    return exact - off, exact + off


def _best(block: Candidates, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[list, list]:
    """The k highest scores, ties to the smaller id (rows ascend by id), best first."""
    if len(rows) > 8 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = scores >= kth
        rows, scores = rows[some], scores[some]
    order = np.lexsort((rows, -scores))[:k]
    return block.ids[rows[order]].tolist(), scores[order].tolist()


def positives_of(
    block: Candidates, bounds: Bounds, anchor_id: int, label: int, anchor: np.ndarray, k: int
) -> tuple[list[int], list[int]]:
    """Ids and scores of the k best rows of the label, without the anchor's own."""
    rows = block.members.get(label)
    if rows is None:
        return [], []
    rows = rows[block.ids[rows] != anchor_id]
    if len(rows) > k:
        least = np.partition(bounds.low[rows], len(rows) - k)[len(rows) - k]
        rows = rows[bounds.high[rows] >= least]  # the others are below k rows for sure
    scores = block.scores(anchor, rows)
    bounds.settle(rows, scores)
    return _best(block, rows, scores, k)


def negatives_of(
    block: Candidates,
    bounds: Bounds,
    label: int,
    anchor: np.ndarray,
    windows: list[tuple[int, int]],
    k: int,
) -> Iterator[tuple[list[int], list[int]]]:
    """For each window (least times 100, most) the k best rows of other labels within it."""
    low = min((least / 100 for least, _ in windows), default=0.0)
    high = max((float(most) for _, most in windows), default=-1.0)
    slack = 1e-9 * (abs(low) + abs(high)) + 1e-6
    rows = np.flatnonzero(
        (bounds.high >= low - slack) & (bounds.low <= high + slack) & (block.labels != label)
    )
    scores = block.scores(anchor, rows)
    bounds.settle(rows, scores)
    for least, most in windows:
        # 100 * score >= least, in integers
        fits = (scores >= -(-least // 100)) & (scores <= most)
        yield _best(block, rows[fits], scores[fits], k)


# -- blocks and groups as rows --------------------------------------------------------------

_ROWS = "number long, ids binary, labels binary, vectors binary, n int"
_TREE = _ROWS + ", parents binary, edges binary"
_WINDOWS = "array<struct<anchor_id:bigint,place:bigint,score:bigint>>"
_FOUND = "number long, anchor_id long, place long, id long, score long"


def _packed(rows: int | None):
    """The rows of a partition as one block, or as groups of at most ``rows`` with their tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [b for b in batches if b.num_rows]
        if not whole:
            return
        table, at = pa.Table.from_batches(whole), TaskContext.get().partitionId() << 32
        for i, start in enumerate(range(0, table.num_rows, rows or table.num_rows)):
            part = table.slice(start, rows or table.num_rows).combine_chunks()
            values = _matrix(part.column("values").chunk(0))
            out = {
                "number": pa.array([at + i if rows else at >> 32], pa.int64()),
                "ids": [_array(part.column("id").to_numpy())],
                "labels": [_array(part.column("label").to_numpy())],
                "vectors": [_array(values)],
                "n": pa.array([len(values)], pa.int32()),
            }
            if rows:
                parent, edge = spanning_tree(values)
                out |= {"parents": [_array(parent)], "edges": [edge.astype("<f8").tobytes()]}
            yield pa.RecordBatch.from_pydict(out)

    return run


def _numbers(cell) -> np.ndarray:
    return np.frombuffer(cell.as_py(), "<i8")


def _mine(k: int, wide: bool):
    """Streams a task's rows: each block of candidates comes before the groups that meet it.

    Gives positives, or if ``wide`` negatives within the windows of a group's anchors.
    """

    def found(block: Candidates, row: dict) -> Iterator[tuple[int, int, int, int]]:
        n = row["n"].as_py()
        ids, labels = _numbers(row["ids"]), _numbers(row["labels"])
        vectors = _numbers(row["vectors"]).reshape(n, -1)
        edges = np.frombuffer(row["edges"].as_py(), "<f8")
        parents = _numbers(row["parents"])
        windows: dict[int, list] = {}
        for w in row["windows"].as_py() or []:
            windows.setdefault(w["anchor_id"], []).append((w["place"], w["score"]))
        known: dict[int, Bounds] = {}
        loose = block.inexact(vectors)
        for at, last, has_children in visits(parents):
            anchor, above = vectors[at], int(parents[at])
            if loose:
                bounds = Bounds.open(block)
            elif above < 0:
                bounds = Bounds.at_root(block, anchor)
            else:
                bounds = known[above].below(float(edges[at]))
                if last:
                    del known[above]
            if has_children and not loose:
                known[at] = bounds
            anchor_id, label = int(ids[at]), int(labels[at])
            if not wide:
                best = positives_of(block, bounds, anchor_id, label, anchor, k)
                yield from ((anchor_id, 0, i, s) for i, s in zip(*best, strict=True))
            elif own := windows.get(anchor_id):
                limits = [(80 * score, score) for _, score in own]
                each = negatives_of(block, bounds, label, anchor, limits, k)
                for (place, _), best in zip(own, each, strict=True):
                    yield from ((anchor_id, place, i, s) for i, s in zip(*best, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = None, None
        names = [part.split()[0] for part in _FOUND.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                if row["number"].as_py() is None:
                    vectors = _numbers(row["vectors"]).reshape(row["n"].as_py(), -1)
                    block = Candidates(_numbers(row["ids"]), _numbers(row["labels"]), vectors)
                    at = row["block"].as_py()
                elif at == row["block"].as_py():
                    columns = list(zip(*found(block, row), strict=True)) or [()] * 4
                    columns = [[row["number"].as_py()] * len(columns[0]), *columns]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def _met(blocks: DataFrame, groups: DataFrame, count: int) -> DataFrame:
    """Each block followed by all groups, block by block in a task of its own."""
    columns = ["ids", "labels", "vectors", "n"]
    first = blocks.select(F.col("number").alias("block"), *columns)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    then = groups.withColumn("block", each)
    met = first.unionByName(then, allowMissingColumns=True).repartition(count, "block")
    return met.sortWithinPartitions("block", F.col("number").asc_nulls_first())


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    key: str,
    vector: str,
    label: str | Column,
    anchors: Column,
    k: int = 5,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components x become floor(scale * x). For each anchor (rows where ``anchors`` holds) and each
    of its k highest-scoring other rows of its label, the k highest-scoring rows of other labels
    whose score is from 0.8 to 1 times the positive's; a positive of negative score has none. Ties
    go to the smaller id, and fewer rows give fewer. Rows with a null key or label, and vectors
    that are null or hold null or non-finite components, take no part. Rows with one key are one
    row: that with the smallest label, then the smallest vector. Shorter vectors count as filled
    up with zeros, empty ones score zero, and an empty table gives no rows. Scores beyond a long
    count as MOST or its negative. Other columns take no part.
    """
    common.prepare_workers(df.sparkSession)
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    label = F.col(label) if isinstance(label, str) else label
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & finite & label.isNotNull()
    parts = [label.cast("long").alias("label"), scaled.alias("values"), F.coalesce(anchors, F.lit(False)).alias("anchor")]
    rows = df.where(usable).select(F.col(key).cast("long").alias("id"), F.struct(*parts).alias("row"))
    one = rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*")
    one = common.written(one, "vectors")
    total, some = one.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    blocks, groups = max(1, -(-total // BLOCK_ROWS)), max(1, -(-some // GROUP_ROWS))
    packed = one.select("id", "label", "values").repartition(blocks).mapInArrow(_packed(None), _ROWS)
    packed = common.written(packed, "blocks")
    tied = one.where("anchor").select("id", "label", "values")
    tied = tied.repartitionByRange(groups, "label", F.xxhash64("id")).sortWithinPartitions("label", "id")
    tied = common.written(tied.mapInArrow(_packed(GROUP_ROWS), _TREE), "groups")

    alone = tied.withColumn("windows", F.lit(None).cast(_WINDOWS))
    near = _top(_met(packed, alone, blocks).mapInArrow(_mine(k, False), _FOUND), k)
    near = near.select("number", "anchor_id", F.col("rank").cast("long").alias("place"), "id", "score")
    near = common.written(near, "positives")
    windows = F.collect_list(F.struct("anchor_id", "place", "score")).alias("windows")
    asked = tied.join(near.groupBy("number").agg(windows), "number")  # k windows an anchor
    found = _top(_met(packed, asked, blocks).mapInArrow(_mine(k, True), _FOUND), k)
    known = near.select(
        "anchor_id", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return found.join(known, ["anchor_id", "place"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
