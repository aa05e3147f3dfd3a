"""Periodic runs: against a plain version, cut into small pieces, and of awkward documents."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidegate.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def brute(words):
    """All runs (start, length, period), by start then period, straight from the definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q) and smallest_period(words[start : start + length]) == q:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed):
    draw = random.Random(seed)
    out = []
    for size in (0, 1, 5, 6, 7, 8, 12, 30, 90, 250):
        for letters in ("a", "ab", "abcdefgh"):
            out.append([draw.choice(letters) for _ in range(size)])
    for _ in range(60):
        words = [str(draw.randrange(40)) for _ in range(draw.randint(0, 80))]
        for _ in range(draw.randint(1, 3)):
            piece = [draw.choice("xyz") for _ in range(draw.randint(1, 40))]
            words += (piece * 9)[: draw.randint(1, 8 * len(piece))]
            words += [str(draw.randrange(40)) for _ in range(draw.choice([0, 0, 1, 50]))]
        out.append(words)
    out += [["ha"] * 700, ["a", "b", "a"] * 200 + ["b"], ["a"] * 100 + ["b"] * 100 + ["a"] * 100]
    out.append((["a"] * 9 + ["b"]) * 40)  # runs within a run
    return [[w.encode() for w in t] for t in out]


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_batches(seed):
    some = texts(seed)
    for words, found in zip(some, runs.batch_runs(some), strict=True):
        own = runs.primitive([(low, high - low + q, q) for q, low, high in found])
        assert own == brute(words)


def test_boundary_matches():
    draw = random.Random(3)
    for _ in range(200):
        words = [draw.choice("ab") for _ in range(draw.randint(2, 40))]
        step = draw.choice([1, 2, 4])
        at = draw.randrange(len(words))
        forward, backward = runs.boundary_matches(words, at, step)
        for q in range(2 * step):
            ahead = 0
            while ahead < 2 * step and at + ahead + q < len(words) and words[at + ahead] == words[at + ahead + q]:
                ahead += 1
            back = 0
            while back < 2 * step and at - back > 0 and at - back - 1 + q < len(words) and words[at - back - 1] == words[at - back - 1 + q]:
                back += 1
            # a period that reaches beyond the words around the boundary has no matches to count
            if at + q <= len(words):
                assert forward[q] == (min(ahead, 2 * step) if at + q < len(words) else 0)
                assert backward[q] == back


def frame(spark, some):
    rows = [(i, b" ".join(t).decode()) for i, t in enumerate(some)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def as_tuples(row):
    return [(r["start"], r["length"], r["period"]) for r in row["runs"]]


@pytest.mark.parametrize("piece", [16, 100, runs.PIECE_WORDS])
def test_pieces(spark, piece):
    """Long texts are cut into pieces for each octave, and their fragments stitched."""
    some = texts(9)
    draw = random.Random(2)
    long = [str(draw.randrange(300)) for _ in range(3000)]
    some.append([w.encode() for w in long + (long[:700] * 5)[:3100] + ["x"] * 900 + long])
    got = runs.with_runs(frame(spark, some), "doc_id", "text", piece=piece).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(some)))
    for r in got:
        want = brute(some[r["doc_id"]])
        assert as_tuples(r) == want, r["doc_id"]
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        kept = [w.decode() for i, w in enumerate(some[r["doc_id"]]) if i not in gone]
        assert r["kept"] == " ".join(kept)
    assert sum(len(r["runs"]) for r in got) > 100


def test_pieces_hold_all_tiles():
    """Any word lies in a piece of each octave with all that the tiles around it read."""
    for size in (17, 1000, 4097, 300_000):
        for piece in (16, 1024):
            if size <= piece:
                continue
            cut = list(runs.pieces(size, piece))
            for level in range(runs.octaves(size)):
                own = sorted((s, e) for first, after, s, e in cut if first <= level < after)
                assert own[0][0] == 0 and own[-1][1] == size
                for (_, end), (start, _) in zip(own[:-1], own[1:], strict=True):
                    assert end - start >= 10 << level


def test_awkward_documents(spark, awkward, nothing):
    clash = awkward.withColumns({"runs": F.lit("x"), "kept": F.lit(1), "k": F.lit(2), "mark": F.lit(3), "period": F.lit(4)})
    got = runs.with_runs(clash, "doc_id", "text")
    assert got.columns == ["doc_id", "runs", "kept"]
    want = sorted((r["doc_id"], " ".join(WORD.findall(r["text"] or ""))) for r in clash.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text").collect())
    rows = got.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "runs", "kept").collect()
    assert len(rows) == len(want)
    long = next(r for r in rows if r["doc_id"] == 5)
    assert as_tuples(long) == [(0, 4000, 10)] and long["kept"].startswith("alpha beta") and len(long["kept"].split()) == 10
    assert sorted((r["doc_id"], r["kept"]) for r in rows if r["doc_id"] != 5) == [w for w in want if w[0] != 5]
    assert runs.with_runs(nothing, "doc_id", "text").count() == 0
    again = spark.createDataFrame([(1, "no " * 8)] * 5 + [(1, "yes " * 9), (None, "no " * 8)], "doc_id long, text string")
    for piece in (4, 100):
        found = runs.with_runs(again, "doc_id", "text", piece=piece).collect()
        assert sorted((str(r["doc_id"]), r["runs"][0]["length"], r["kept"]) for r in found) == [("1", 8, "no")] * 5 + [("1", 9, "yes"), ("None", 8, "no")]


def test_query(spark):
    """Against a version straight from the contract; most documents of a tenth have a run."""
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_periodic_runs"](spark, folder).collect()}
    assert len(got) == len(rows)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    planted = 0
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if len(words) > 4000:
            continue
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        want = brute(words)
        planted += h % 10 == 0 and bool(want)
        r = got[doc_id]
        assert r["n_runs"] == len(want)
        if want:
            best = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            assert (r["start"], r["length"], r["period"]) == best
            assert r["exponent_milli"] == 1000 * best[1] // best[2]
        else:
            assert r["start"] is r["length"] is r["period"] is r["exponent_milli"] is None
        assert r["runs_sha256"] == sha("".join(f"{a},{b},{c}\n" for a, b, c in want))
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        assert r["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in gone))
    assert planted > 5
