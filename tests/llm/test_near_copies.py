"""Near copies: keys, fingerprints and the ring, then groups against all pairs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import common, near_copies
from test_simhash import brute_components


def jaccard(a, b, size=5):
    sets = []
    for text in (a, b):
        words = near_copies._word(text.lower())
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_copies(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("aeioudlnrst") for _ in range(draw.randint(2, 9)))
    texts, at = {}, 0
    for _ in range(40):
        base = [word() for _ in range(draw.choice([8, 60, 300, 900]))]
        for _ in range(draw.randint(1, 5)):
            copy = base[:]
            for _ in range(draw.choice([0, 0, len(base) // 100])):
                copy[draw.randrange(len(copy))] = word()
            texts[at] = " ".join(copy)
            at += 1
    rows = [(i, t) for i, t in texts.items()] + [(1000, None), (1001, ""), (None, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a", F.lit(1))
    want = brute_components(sorted(texts), lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    kept = near_copies.without_near_copies(df, "doc_id", "text")
    assert kept.columns == df.columns
    got = {r["doc_id"] for r in kept.collect()}
    assert got == {i for i, r in want.items() if i == r} | {1000, None}
    assert near_copies.without_near_copies(df.where("1 = 0"), "doc_id", "text").count() == 0


def shingles(text, size=5):
    (words,) = near_copies.hashed_words([text])
    return near_copies.shingle_set(words, size)


def test_sketch_of_long_texts():
    draw = random.Random(2)
    a = [str(draw.randrange(10**6)) for _ in range(6_000)]
    for changed in (0, 60, 300, 1500):
        b = a[:]
        for i in draw.sample(range(len(a)), changed):
            b[i] = "x"
        x, y = " ".join(a), " ".join(b)
        estimate = near_copies.similarity(*(near_copies.sketch(shingles(t)) for t in (x, y)))
        assert estimate == pytest.approx(jaccard(x, y), abs=0.08)
        assert near_copies.jaccard(*(shingles(t).tobytes() for t in (x, y))) == pytest.approx(jaccard(x, y))
    assert near_copies.similarity(*[near_copies.sketch(shingles(""))] * 2) == 1.0
    assert np.all(near_copies.fingerprint(shingles("")) == 0) and len(near_copies.chunk_keys(shingles(""))) == 0


def test_ring_keeps_all_within_the_radius():
    draw = np.random.default_rng(5)
    differ = np.zeros((3000, 128), dtype=np.uint8)
    for i, row in enumerate(differ):
        row[draw.choice(128, i % 90, replace=False)] = 1
    packed = np.packbits(differ, axis=1, bitorder="little").view(np.int64)
    within = differ.sum(axis=1) <= near_copies.RADIUS
    assert (near_copies.on_ring(packed) >= within).all()
    assert (near_copies.near(packed) == within).all()
    # the ring alone spares most of the far ones
    assert near_copies.on_ring(packed)[differ.sum(axis=1) > 60].mean() < 0.1


def test_similar_texts_share_keys_and_are_near():
    """Of pairs of 0.8 or more, of any length and kind of edit, hardly one is no candidate."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("aeioudlnrst") for _ in range(draw.randint(2, 9)))
    pairs = lost = far = 0
    for turn in range(1500):
        base = [word() for _ in range(draw.choice([12, 30, 50, 70, 100, 150, 170, 200, 230, 400, 900]))]
        copy, share = base[:], draw.random() * 0.2
        if turn % 3 == 0:
            copy = copy + [word() for _ in range(int(share * len(copy)))]
        elif turn % 3 == 1:
            copy = copy[int(share * len(copy)) :]
        else:
            for i in draw.sample(range(len(copy)), max(1, int(share * len(copy) / 6))):
                copy[i] = word()
        x, y = " ".join(base), " ".join(copy)
        if base == copy or jaccard(x, y) < 0.8:
            continue
        pairs += 1
        a, b = near_copies.hashed_words([x, y])
        lost += not len(np.intersect1d(near_copies.chunk_keys(a), near_copies.chunk_keys(b)))
        prints = [near_copies.fingerprint(near_copies.shingle_set(w, 5)) for w in (a, b)]
        far += not near_copies.near((prints[0] ^ prints[1])[None, :])[0]
    assert pairs > 700 and lost + far <= 0.004 * pairs, f"{lost} and {far} of {pairs}"


def test_near_copies_with_text_added_cut_and_replaced(spark):
    """Against all pairs, each kind of edit around the threshold."""
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("aeioudlnrst") for _ in range(draw.randint(2, 9)))
    line = [word() for _ in range(12)]
    texts, kinds = {}, {}
    for kind in ("added", "before", "cut", "replaced"):
        for share in (0.03, 0.08, 0.15, 0.22, 0.3):
            for _ in range(6):
                base = line + [word() for _ in range(draw.randint(60, 230))]
                part = max(1, int(share * len(base)))
                copy = base[:]
                if kind == "added":
                    copy += [word() for _ in range(part)]
                elif kind == "before":
                    copy = [word() for _ in range(part)] + copy
                elif kind == "cut":
                    copy = copy[part:]
                else:
                    for i in draw.sample(range(len(copy)), max(1, part // 5)):
                        copy[i] = word()
                at = len(texts)
                texts[at], texts[at + 1], kinds[at + 1] = " ".join(base), " ".join(copy), kind
    alike = {b: jaccard(texts[b - 1], texts[b]) >= 0.8 for b in kinds}
    assert all(any(alike[b] for b in kinds if kinds[b] == k) for k in set(kinds.values()))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df, "doc_id", "text").collect()}
    assert got == {b: b - 1 for b in kinds if alike[b]}


def test_groups_that_drift_away_from_hubs(spark):
    """Each text is a near copy of its neighbours alone, and all its shingles are crowded."""
    draw = random.Random(7)
    words = ["".join(draw.choice("aeioudlnrst") for _ in range(8)) for _ in range(700)]
    texts = {i: " ".join(words[3 * i : 3 * i + 100]) for i in range(200)}
    texts |= {1000 + i: f"{texts[i]} {texts[199 - i]}" for i in range(0, 60, 20)}
    want = brute_components(sorted(texts), lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    assert {want[i] for i in range(200)} == {0}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df, "doc_id", "text").collect()}
    assert got == {i: r for i, r in want.items() if i != r}


def test_long_texts_near_the_threshold(spark):
    """Similarities of 0.77 to 0.83, where the estimate of a sketch errs."""
    draw = random.Random(8)
    texts, want = {}, {}
    for i in range(60):
        base = ["".join(draw.choice("aeioudlnrst") for _ in range(8)) for _ in range(900)]
        copy = base[: 900 - draw.randint(155, 205)]
        texts[2 * i], texts[2 * i + 1] = " ".join(base), " ".join(copy)
        if jaccard(texts[2 * i], texts[2 * i + 1]) >= 0.8:
            want[2 * i + 1] = 2 * i
    assert 20 < len(want) < 40
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df, "doc_id", "text").collect()}
    assert got == want


@pytest.mark.parametrize("few", [4, 64])
def test_crowded_places(spark, monkeypatch, few):
    """A passage in many texts that are unrelated otherwise, among them small groups of copies."""
    monkeypatch.setattr(near_copies, "FEW", few)
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("aeioudlnrst") for _ in range(draw.randint(2, 9)))
    passage = [word() for _ in range(60)]
    texts = {}
    for i in range(150):
        base = [word() for _ in range(120)]
        for k in range(1 + (i % 10 == 0)):
            copy = base[:]
            if k:
                copy[draw.randrange(120)] = word()
            texts[len(texts)] = " ".join(copy[:50] + passage + copy[50:])
    want = brute_components(sorted(texts), lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df, "doc_id", "text").collect()}
    assert got == {i: r for i, r in want.items() if i != r} and len(got) == 15


def test_near_copies_that_share_crowded_places_alone(spark, monkeypatch):
    """Texts are passages of a small stock; near copies differ where two passages meet."""
    monkeypatch.setattr(near_copies, "BLOCK", 16)
    monkeypatch.setattr(near_copies, "LEARN", 50)
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("aeioudlnrst") for _ in range(draw.randint(2, 9)))
    stock = [[word() for _ in range(60)] for _ in range(12)]
    chosen = draw.sample(list(itertools.permutations(range(12), 3)), 300)
    made = [[w for k in some for w in stock[k]] for some in chosen]
    made += [[word() if i in (60, 120) else w for i, w in enumerate(some)] for some in made[:100]]
    draw.shuffle(made)
    texts = {i: " ".join(words) for i, words in enumerate(made)}
    places = {i: set(near_copies.chunk_keys(next(near_copies.hashed_words([t])))) for i, t in texts.items()}
    prints = {i: near_copies.fingerprint(shingles(t)) for i, t in texts.items()}

    def linked(a, b):
        close = near_copies.near((prints[a] ^ prints[b])[None, :])[0]
        return close and bool(places[a] & places[b]) and jaccard(texts[a], texts[b]) >= 0.8

    want = brute_components(sorted(texts), linked)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df, "doc_id", "text").collect()}
    assert len(got) > 200
    assert got == {i: r for i, r in want.items() if i != r}


def test_no_table_grows_with_the_square_of_a_group(spark, monkeypatch):
    """Texts of a form, most pairs below the similarity, and copies of some of them."""
    draw = random.Random(13)
    word = lambda: "".join(draw.choice("aeioudlnrst") for _ in range(draw.randint(2, 9)))
    form, made = [word() for _ in range(120)], []
    for i in range(280):
        made.append(form[:])
        for at in draw.sample(range(10, 110), 3):
            made[-1][at] = word()
        if i % 14 == 0:
            made.append(made[-1][:-1])
    draw.shuffle(made)
    texts = {i: " ".join(words) for i, words in enumerate(made)}
    want = brute_components(sorted(texts), lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    rows, before = {}, common.written

    def counted(table, label):
        found = before(table, label)
        rows[label] = max(rows.get(label, 0), found.count())
        return found

    monkeypatch.setattr(common, "written", counted)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df, "doc_id", "text").collect()}
    assert got == {i: r for i, r in want.items() if i != r} and len(got) < 150
    assert max(rows.values()) < len(texts) ** 2 / 4, rows


@pytest.mark.parametrize("values", [300, 4_000_000])
def test_in_common_and_forest(monkeypatch, values):
    monkeypatch.setattr(near_copies, "VALUES", values)
    monkeypatch.setattr(near_copies, "COLUMNS", 7)
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 200, draw.integers(0, 60))).astype(np.uint64) for _ in range(40)]
    want = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    assert (near_copies.in_common(sets) * (1 - np.eye(40)) == np.array(want) * (1 - np.eye(40))).all()
    groups = np.arange(40) // 2
    linked = draw.random((40, 40)) < 0.03
    linked |= linked.T
    edges = near_copies.forest(linked, groups)
    assert all(linked[i, j] for i, j in edges) and len(edges) < 20
    ends = {(int(groups[i]), int(groups[j])) for i, j in edges}
    assert len({frozenset(e) for e in ends}) == len(edges)
    all_ends = {(int(groups[i]), int(groups[j])) for i, j in np.argwhere(linked)}
    every = brute_components(list(range(20)), lambda a, b: (a, b) in all_ends)
    assert brute_components(list(range(20)), lambda a, b: (a, b) in ends or (b, a) in ends) == every


def test_scratch_is_removed(spark, monkeypatch):
    """Tables made on the way go; the result stays."""
    paths = []
    before = common.work_folder
    monkeypatch.setattr(common, "work_folder", lambda s, label: paths.append(before(s, label)) or paths[-1])
    df = spark.createDataFrame([(i, "one two three four five six seven eight" * (i % 3)) for i in range(9)], "doc_id long, text string")
    found = near_copies.near_copies(df, "doc_id", "text")
    fs = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    there = [p for p in paths if fs(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs(p))]
    assert len(paths) > 8 and len(there) == 1 and found.count() == 6
