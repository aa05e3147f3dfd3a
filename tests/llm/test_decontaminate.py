import random
from collections import Counter

import numpy as np
import pytest

from tidegate.llm import decontaminate


def words(draw, count):
    return ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 6))) for _ in range(count)]


def brute(items, document):
    """Weighted Jaccard similarity of each item with its best window."""
    shingle = lambda w, n: [tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    import math

    among = Counter(s for w in items.values() for s in set(shingle(w, 2)))
    weight = lambda s: 1 + math.log(len(items) / among[s]) if s in among else 1 + math.log(len(items))
    out, held = {}, set(shingle(document, 1) + shingle(document, 2))
    for k, item in items.items():
        if not held & set(shingle(item, 2)):
            continue  # no window shares a shingle with it
        for at in range(max(1, len(document) - len(item) + 1)):
            window = document[at : at + len(item)]
            a, b = Counter(shingle(item, 2)), Counter(shingle(window, 2))
            both = sum(min(a[s], b[s]) * weight(s) for s in a | b)
            out[k] = max(out.get(k, 0), both / sum(max(a[s], b[s]) * weight(s) for s in a | b))
    return out


def near_by_fingerprint(found, items, document, k):
    """Whether any window of the item's size within the radius has the least similarity."""
    words = found.alphabet.word_hashes([" ".join(document)])[0]
    at, size = found.ids.index(k), len(items[k])
    shingles = decontaminate.shingle_hashes(words, min(2, size))
    wide = max(1, min(size - min(2, size) + 1, len(shingles)))
    prints = found._windows(shingles, wide)
    near = decontaminate.within_radius(prints ^ found.fingerprints[at][None, :])
    return any(
        found.similarity(shingles[i : i + wide], found.shingles[at]) >= 0.8 for i in np.flatnonzero(near)
    )


def cases(seed, edits):
    draw = random.Random(seed)
    frame = words(draw, 24)
    items = {i: words(draw, draw.randint(1, 59)) for i in range(60)}
    items |= {60 + i: frame[:12] + words(draw, draw.randint(1, 6)) + frame[12:] for i in range(20)}
    found = decontaminate.Items([(i, " ".join(w)) for i, w in items.items()])
    for k in sorted(items):
        passage = items[k][:]
        for _ in range(draw.choice(edits)):
            passage[draw.randrange(len(passage))] = "edited"
        at = draw.randint(0, 30)
        yield found, items, words(draw, at) + passage + words(draw, 40 - at)


def test_against_brute_force():
    """All windows within the radius and of the least similarity are found, and nothing else."""
    exact = 0
    for found, items, document in cases(3, [0, 0, 1]):
        (got,) = found.matches([" ".join(document).title()])
        got = {found.ids[k]: m[0] for k, m in got.items()}
        want = {k: s for k, s in brute(items, document).items() if s >= 0.8}
        assert set(got) == {k for k in want if near_by_fingerprint(found, items, document, k)}
        assert {k for k, s in want.items() if s > 0.999} <= set(got)
        assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got if want[k] > 0.999)
        exact += sum(s > 0.999 for s in want.values())
    assert exact > 40


def test_recall_of_edited_windows():
    """Of all windows of 0.8 or more, wherever they are, hardly one is beyond the radius."""
    near = missed = 0
    for seed in range(25):
        for found, items, document in cases(100 + seed, [1, 1, 2, 3, 4]):
            (got,) = found.matches([" ".join(document)])
            got = {found.ids[k] for k in got}
            similar = brute(items, document).items()
            want = {k for k, s in similar if s >= 0.8 + 1e-9}
            assert got <= {k for k, s in similar if s >= 0.8 - 1e-9}
            near += len(want)
            missed += len(want - got)
    assert near > 700 and missed <= 0.005 * near, f"{missed} of {near}"


def test_windows_short_of_anchors_are_not_similar():
    """Whichever shingles an edit takes, what is left weighs enough or is not similar."""
    draw = random.Random(8)
    for found, items, _ in cases(4, [0]):
        for at, shingles in enumerate(found.shingles):
            anchors, weights, need = found._anchors(shingles)
            for _ in range(20):
                kept = np.array([draw.random() < 0.85 for _ in shingles], dtype=bool)
                other = [draw.getrandbits(63) for _ in range(int((~kept).sum()))]
                window = np.concatenate((shingles[kept], np.array(other, dtype=np.uint64)))
                held = weights[np.isin(anchors, window)].sum()
                assert found.similarity(window, shingles) < 0.8 or held >= need
        break


def test_equal_blocks():
    draw = np.random.default_rng(2)
    for count in (0, 1, 40, 76, 77, 128, 200):
        bits = np.zeros((50, 256), dtype=np.uint8)
        for row in bits:
            row[draw.choice(256, count, replace=False)] = 1
        differ = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        equal = (bits.reshape(50, 128, 2).sum(axis=2) == 0).sum(axis=1)
        assert (decontaminate.equal_blocks(differ) == equal).all()
        assert (decontaminate.within_radius(differ) == (count <= decontaminate.RADIUS)).all()


def test_rows(spark, awkward, nothing):
    benchmark = spark.createDataFrame(
        [
            (1, "two, THREE four five six seven"),
            (2, "beta gamma delta epsilon zeta eta theta iota"),
            (3, None),
            (4, ""),
            (None, "One two three"),
            (5, "never seen words of an item"),
            (1, "two, THREE four five six seven"),
        ],
        "item_id long, text string",
    )
    found = decontaminate.find_leaks(awkward, "doc_id", "text", benchmark, "item_id", "text")
    rows = sorted((r["doc_id"], r["item_id"], r["similarity"], r["first_word"]) for r in found.collect())
    assert rows == [(1, 1, 1.0, 1), (2, 1, 1.0, 1), (2, 1, 1.0, 1), (5, 2, 1.0, 1)]
    kept = decontaminate.without_leaks(awkward, "text", benchmark, "item_id", "text")
    assert kept.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted("3 4 None None 6 7".split())
    for empty in (nothing, awkward):
        items = benchmark if empty is nothing else benchmark.where("1 = 0")
        assert decontaminate.find_leaks(empty, "doc_id", "text", items, "item_id", "text").count() == 0


def test_many_sets_of_items(spark, awkward, monkeypatch):
    """However the items are dealt into sets, similarities are the same."""
    draw = random.Random(5)
    frame = words(draw, 10)
    items = [frame + words(draw, 40) for _ in range(30)]
    rows = [(i, " ".join(w)) for i, w in enumerate(items)]
    rows += [(100, "two three four five six seven"), (101, "beta gamma delta epsilon zeta eta theta iota")]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    texts = [(i, " ".join(words(draw, 5) + w[:11] + ["edited"] + w[12:])) for i, w in enumerate(items)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").union(awkward.select("doc_id", "text"))
    find = lambda: sorted(
        (str(r["doc_id"]), r["item_id"], round(r["similarity"], 9))
        for r in decontaminate.find_leaks(docs, "doc_id", "text", benchmark, "item_id", "text").collect()
    )
    want = find()
    assert len(want) > 20
    monkeypatch.setattr(decontaminate, "BROADCAST_CHARS", 600)
    assert find() == want
    kept = decontaminate.without_leaks(awkward, "text", benchmark, "item_id", "text")
    assert kept.count() == 6


def test_documents_hold_their_items(spark):
    folder = "/root/testdata/sf0.01"
    documents, benchmark = (
        spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark")
    )
    found = decontaminate.find_leaks(documents, "doc_id", "text", benchmark, "item_id", "text")
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    items = benchmark.collect()
    want = {
        (d["doc_id"], i["item_id"])
        for d in documents.collect()
        for i in items
        if i["text"] in d["text"]
    }
    assert got == want and want
