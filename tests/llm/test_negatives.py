"""Hard negatives: against all pairs, over several blocks and groups, and of awkward rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import negatives

SCHEMA = "id long, v array<double>, label int"


def brute(rows, anchors, k=5, scale=256):
    ok = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [max(-(1 << 63), min((1 << 63) - 1, math.floor(x * scale))) for x in v]
        ok[i] = min(ok.get(i, (label, q)), (label, q))
    most = (1 << 63) - 1
    score = lambda a, b: max(-most, min(most, sum(x * y for x, y in zip(ok[a][1], ok[b][1]))))  # noqa: E731, B905
    out = []
    for a in sorted(i for i in ok if anchors(i)):
        same = sorted((-score(a, b), b) for b in ok if b != a and ok[b][0] == ok[a][0])[:k]
        other = sorted((-score(a, b), b) for b in ok if ok[b][0] != ok[a][0])
        for s, p in same:
            fits = [(t, n) for t, n in other if 80 * -s <= 100 * -t <= 100 * -s][:k]
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n) in enumerate(fits)]
    return sorted(out)


def found(df, label="label", every=10, **more):
    out = negatives.hard_negatives(df, "id", "v", label, F.col("id") % every == 0, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(seed, size=400, width=6, spread=1.0, labels=4):
    """Vectors around few centres, with copies and very common ones, so that scores tie."""
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(size):
        c = centres[0] if draw.random() < 0.3 else draw.choice(centres)
        v = [x + spread * draw.choice([0, 0.05, 0.3]) * draw.gauss(0, 1) for x in c]
        rows.append((i, v, draw.randrange(labels)))
    return rows


@pytest.mark.parametrize("block, group", [(32_768, 512), (50, 7), (1000, 1)])
def test_against_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "GROUP_ROWS", group)
    rows = vectors(block + group)
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows, lambda i: i % 10 == 0) and len(got) > 300


def test_bounds_spare_rows_and_lose_none():
    """Bounds from parents hold for every candidate, and near anchors settle few of them."""
    rows = vectors(3, 3000, 16, 0.2)
    ids = np.array([r[0] for r in rows])
    values = np.array([[math.floor(x * 256) for x in r[1]] for r in rows])
    block = negatives.Candidates(ids, np.array([r[2] for r in rows]), values)
    group = values[::30]
    parent, edge = negatives.spanning_tree(group)
    assert (parent < 0).sum() == 1
    known, order, narrowed = {}, list(negatives.visits(parent)), []
    assert sorted(at for at, _, _ in order) == list(range(len(group)))
    for at, _, _ in order:
        bounds = negatives.Bounds.at_root(block, group[at]) if parent[at] < 0 else known[parent[at]].below(edge[at])
        known[at] = bounds
        exact = values @ group[at]
        assert (bounds.low <= exact).all() and (exact <= bounds.high).all()
        if parent[at] >= 0:
            best = exact.max()
            narrowed.append(((bounds.high >= 0.8 * best) & (bounds.low <= best)).mean())
            close = np.flatnonzero(bounds.high >= 0.8 * best)
            bounds.settle(close, exact[close])
    assert np.median(narrowed) < 0.7


def test_least_spanning_tree():
    draw = np.random.default_rng(1)
    points = draw.integers(-50, 50, (40, 3))
    parent, edge = negatives.spanning_tree(points)
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    # Kruskal's total
    root, total = list(range(40)), 0.0

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in sorted(((i, j) for i in range(40) for j in range(i)), key=lambda p: distance[p]):
        if top(i) != top(j):
            root[top(i)], total = top(j), total + distance[i, j]
    assert edge.sum() == pytest.approx(total)
    assert all(distance[i, p] == pytest.approx(e) for i, (p, e) in enumerate(zip(parent, edge, strict=True)) if p >= 0)


def test_remembered_nodes_are_few():
    """However deep or wide a tree is, few bounds wait for children."""
    for parent in (
        np.array([-1, *range(499)]),
        np.array([-1] + [0] * 499),
        np.array([-1] + [(i - 1) // 2 for i in range(1, 511)]),
        np.array([-1] + [max(0, i - random.Random(i).randint(1, 9)) for i in range(1, 500)]),
    ):
        known, most = set(), 0
        for at, last, has_children in negatives.visits(parent):
            if parent[at] >= 0:
                assert int(parent[at]) in known
                if last:
                    known.discard(int(parent[at]))
            if has_children:
                known.add(at)
            most = max(most, len(known))
        assert not known and most <= 11


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(8, 120)
    rows += [(None, [1.0] * 6, 1), (200, None, 1), (210, [1.0, None], 2), (220, [nan], 1), (230, [inf], 0),
             (240, [1.0] * 6, None), (250, [], 1), (251, [], 2), (260, [1.0], 1), (270, [2.0] * 9, 0),
             (30, rows[30][1], 3), (30, rows[30][1], 0), (31, rows[31][1], rows[31][2])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == brute(rows, lambda i: i % 10 == 0)
    clash = df.withColumns({"row": F.lit(1), "values": F.lit("x"), "anchor": F.lit(0), "number": F.lit(2), "n": F.lit(3)})
    assert found(clash) == found(df)
    assert found(df.where("1 = 0")) == [] and found(df.where("id is null")) == []
    assert found(df.where("id = 10")) == [] and found(df.where("label is null")) == []


def test_scores_beyond_doubles(spark):
    """Products that no double holds are computed as integers; beyond a long they are cut off."""
    draw = random.Random(4)
    rows = [(i, [draw.choice([1e9, 1e9 + 1, -1e9]) for _ in range(3)], i % 2) for i in range(40)]
    got = found(spark.createDataFrame(rows, SCHEMA), scale=1)
    assert got == brute(rows, lambda i: i % 10 == 0, scale=1) and got
    rows = [(i, [1e300, float(i)], i % 2) for i in range(20)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows, lambda i: i % 10 == 0) and {r[4] for r in got} == {(1 << 63) - 1}


def test_more_label_columns(spark):
    rows = vectors(5, 150)
    df = spark.createDataFrame(rows, SCHEMA)
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label"))
    want = brute([(i, v, (x + 1) % 4 if i % 7 == 0 else x) for i, v, x in rows], lambda i: i % 10 == 0, k=2)
    assert found(df, moved, k=2) == want
