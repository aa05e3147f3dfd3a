import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegate.llm import simhash
from tidegate.llm.components import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    found = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else []
    if 0 < len(words) <= 2:
        found = [b" ".join(words)]
    hashed = [xxhash.xxh64_intdigest(s, 42) for s in found]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))
    return bits - (1 << 64) if bits >> 63 else bits


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randint(0, 200), draw.randint(0, 200)) for _ in range(150)]
    edges += [(i, i + 1) for i in range(300, 360)] + [(500, i) for i in range(400, 480)]
    edges += [(7, 7), (None, 3), (3, None), edges[0]]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    pairs = {frozenset(e) for e in edges if None not in e}
    nodes = sorted({n for e in edges if None not in e for n in e})
    want = brute_components(nodes, lambda a, b: frozenset((a, b)) in pairs)
    assert all(got.get(n, n) == r for n, r in want.items())
    assert all(got[n] != n for n in got)
    assert components(df.where("1 = 0")).count() == 0


@pytest.mark.parametrize(("segments", "dense"), [(3, 64), (5, 64), (5, 3), (7, 2)])
def test_links_connect_what_is_near(spark, segments, dense):
    draw = random.Random(segments + dense)
    prints = set()
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(draw.randint(1, 14)):
            f = base
            for _ in range(draw.randint(0, 5)):
                f ^= 1 << draw.randrange(64)
            prints.add(f - (1 << 64) if f >> 63 else f)
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    rows = spark.createDataFrame([(0, f, f) for f in prints], "tab int, id long, fp long")
    links = simhash.candidate_links(rows, segments, dense)
    assert all(near(r["a"], r["b"]) for r in links.collect())
    got = {r["node"]: r["root"] for r in components(links).collect()}
    want = brute_components(sorted(prints), near)
    assert {n: got.get(n, n) for n in prints} == want


def test_fingerprint_components(awkward, nothing):
    rows = simhash.fingerprint_components(awkward, "doc_id", "text").collect()
    assert len(rows) == awkward.count()
    want = sorted((str(r["doc_id"]), brute_fingerprint(r["text"])) for r in awkward.collect())
    assert sorted((str(r["doc_id"]), r["fp"]) for r in rows) == want
    named = {(r["doc_id"], r["fp"]): r["component_id"] for r in rows}
    assert named[2, brute_fingerprint("One two three four five six seven eight.")] == 1
    assert named[4, 0] == named[6, 0] == named[None, 0] == 3  # empty texts are linked
    assert named[None, brute_fingerprint("A text without a key")] is None
    assert simhash.fingerprint_components(nothing, "doc_id", "text").count() == 0


def test_fingerprints_of_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in simhash.fingerprint_components(documents, "doc_id", "text").collect()}
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in documents.collect()}
    near = lambda a, b: ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= 2
    want = brute_components(sorted(prints), near)
    assert {i: (r["fp"], r["component_id"]) for i, r in got.items()} == {
        i: (prints[i], want[i]) for i in prints
    }
