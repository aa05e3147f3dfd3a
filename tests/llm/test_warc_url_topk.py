import base64
import gzip
import hashlib
import random

import numpy as np
import pytest

from tidegate.llm import topk, url_filter, warc

# -- archives -----------------------------------------------------------------------------------

PAGES = [
    (5, "http://a/5", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (9, "http://a/9", "<p>same</p>"),
    (1, "http://a/1", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n🙂"),
    (3, None, None),
    (4, "http://a/4", ""),
    (6, "http://a/6\r\nX: y", "line\n" * 50_000),
    (7, "http://a/7", "\r\n\r\n"),
    (8, "http://a/8", "x"),
    (8, "http://a/8", "x"),
    (None, "http://a/n", "only without a key"),
    (None, "http://a/m", "<p>same</p>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "clash", 1) for r in PAGES]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, record_type string, value long"
    )


@pytest.mark.parametrize("least", [0, 5])
def test_archives(spark, pages, tmp_path, least):
    path = str(tmp_path / "archives")
    archive = warc.Archive(records=3, least_bytes=least)
    warc.write_archives(pages, path, "page_id", "url", "html", archive)
    rows = warc.read_archives(spark, path).collect()
    assert len(rows) == len(PAGES)
    got = sorted(
        (r["key"] or "", r["record_type"], r["refers_to"], r["payload_digest"], r["payload_bytes"])
        for r in rows
    )
    want = []
    for key, _, html in PAGES:
        data = (html or "").encode()
        same = [k for k, _, h in PAGES if (h or "") == (html or "") and k is not None]
        first = min(same, default=None)
        again = len(data) >= least and first is not None and key != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        key = "" if key is None else str(key)
        want.append((key, "revisit" if again else "response", str(first) if again else None, digest, len(data)))
    assert got == sorted(want, key=lambda r: (r[0], r[1]))
    for r in rows:
        if r["record_type"] == "response" and r["key"]:
            html = next(h for k, _, h in PAGES if str(k) == r["key"])
            assert bytes(r["payload"]).decode() == (html or "")
        else:
            assert r["key"] in (None, "") or r["payload"] is None
    assert next(r["url"] for r in rows if r["key"] == "6") == "http://a/6%0D%0AX: y"


def test_no_pages(spark, pages, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(pages.where("1 = 0"), path, "page_id", "url", "html")
    assert warc.read_archives(spark, path).count() == 0


def test_archives_are_cut_by_bytes(spark, tmp_path):
    """Records of very different lengths: an archive ends with the record that reaches the bound."""
    path = str(tmp_path / "cut")
    rows = [(i, f"http://a/{i}", chr(97 + i % 26) * (10 if i % 7 else 40_000) + str(i)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, path, "page_id", "url", "html", warc.Archive(bytes=100_000, compression="none"))
    sizes = [f.stat().st_size for f in (tmp_path / "cut").rglob("part-*")]
    assert len(sizes) > 10 and max(sizes) < 100_000 + 41_000
    back = {r["key"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, path).collect()}
    assert back == {str(k): html for k, _, html in rows}


@pytest.mark.parametrize("old, new", [(b"same", b"lame"), (b"</p>", b"</p")])
def test_broken_archives_are_refused(spark, pages, tmp_path, old, new):
    path = tmp_path / "broken"
    warc.write_archives(pages, str(path), "page_id", "url", "html", warc.Archive(compression="none"))
    for file in path.rglob("*"):
        if file.name.startswith(".part-"):
            file.unlink()  # checksums of the local file system
        elif file.name.startswith("part-"):
            file.write_bytes(file.read_bytes().replace(old, new))
    with pytest.raises(Exception, match="bytes|no record begins"):
        warc.read_archives(spark, str(path)).collect()


def test_members_of_an_archive():
    """Archives of others: each record compressed alone."""
    def record(kind, body, more=""):
        block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + body
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n{more}Content-Length: {len(block)}\r\n\r\n"
        return gzip.compress(head.encode() + block + b"\r\n\r\n")

    data = record("response", b"one\r\n\r\ntwo") + record("revisit", b"", "WARC-Refers-To: <urn:record:4>\r\n")
    found = list(warc.parse_records(data))
    assert [(h["warc-type"], p) for h, _, p in found] == [("response", b"one\r\n\r\ntwo"), ("revisit", b"")]
    with pytest.raises(ValueError):
        list(warc.parse_records(b"no archive"))


# -- URLs ---------------------------------------------------------------------------------------

RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block"}
URLS = [
    ("http://www.example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/"),
    ("http://m.EXAMPLE.com/en/1", "m.example.com", "/en/1", "example.com/en/"),
    ("https://example.com/en/", "example.com", "/en/", "example.com/en/"),
    ("https://example.com/en", "example.com", "/en", "com/"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/"),
    ("https://example.com", "example.com", "", None),
    ("https://com/x", "com", "/x", "com/"),
    ("ftp://a.net/es/", "a.net", "/es/", "net/es/"),
    ("ftp://a.net?/es/", "a.net", "", None),
    ("a.net/es/", "", "", None),
    ("http://a.net/b://c.com/", "a.net", "/b://c.com/", None),
    ("HTTP://ÄÉ.Org#f", "ÄÉ.org", "", None),
    ("x\n://y.com/\nz", "y.com", "/\nz", "com/"),
    ("", "", "", None),
    (None, "", "", None),
]


@pytest.fixture(scope="module")
def weights(spark):
    return url_filter.train(url_filter.labelled_urls(spark))


def test_rules(spark, weights):
    rows = [(u, "clash") for u, *_ in URLS] * 2
    df = spark.createDataFrame(rows, "url string, note string")
    found = url_filter.judge(df, "url", RULES, weights)
    got = [(r["url"], r["host"], r["path"], r["rule"]) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, URLS * 2))
    assert all(r["verdict"] == RULES[r["rule"]] for r in found.collect() if r["rule"])
    assert url_filter.judge(df.where("1 = 0"), "url", RULES, weights).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_new_urls(spark, weights):
    wanted = ["https://science-library.org/a", "http://blog.health.net/en/3", "https://x.org/museum/1"]
    unwanted = ["http://best-casino.org/play", "http://cheap.pills.net/viagra", "https://x.org/warez/crack"]
    df = spark.createDataFrame([(u,) for u in wanted + unwanted], "url string")
    got = {r["url"]: r["verdict"] for r in url_filter.judge(df, "url", {}, weights).collect()}
    assert [got[u] for u in wanted + unwanted] == ["allow"] * 3 + ["block"] * 3


def test_gradient(spark, weights):
    """The same training in numpy, from the same buckets."""
    from pyspark.sql import functions as F

    host, path = url_filter.host_and_path(F.col("url"))
    rows = url_filter.labelled_urls(spark).select(
        url_filter.features(host, path).alias("g"), "label"
    ).collect()
    w = np.zeros(url_filter.BUCKETS + 1)
    squares = np.zeros_like(w)
    for _ in range(url_filter.STEPS):
        slope = np.zeros_like(w)
        for r in rows:
            scale = np.sqrt(len(r["g"]))
            error = 1 / (1 + np.exp(-w[r["g"]].sum() / scale)) - r["label"]
            np.add.at(slope, r["g"], error / scale)
        w *= 1 - url_filter.RATE * url_filter.DECAY
        squares += slope**2
        some = slope != 0
        w[some] -= url_filter.RATE * slope[some] / np.sqrt(squares[some])
    assert np.allclose(w, weights, atol=1e-4)


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([("http://a/", None)], "url string, label int")
    assert set(url_filter.train(none)) == {0.0}


# -- top k --------------------------------------------------------------------------------------


def brute(rows, queries, k):
    clean = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = set()
    for q, a in clean:
        if q not in queries:
            continue
        found = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q]
        out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k])}
    return out


@pytest.mark.parametrize(("spread", "k"), [(0.2, 5), (1e-3, 3), (3.0, 1), (40.0, 5)])
def test_top_k(spark, monkeypatch, spread, k):
    draw = np.random.default_rng(int(spread * 1000))
    vectors = draw.normal(0, spread, (400, 12)).astype(np.float32)
    vectors[100:140] = vectors[0]  # ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1001, [1.0, None]), (1002, [float("nan")] * 12), (1003, [float("inf")])]
    rows += [(None, [1.0] * 12), (1004, []), (1005, [0.5]), (1050, [0.1] * 14)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    found = topk.top_k(df, "vec_id", "embedding", df.where("vec_id % 50 = 0"), k)
    got = {(r["query_id"], r["rank"], r["id"], r["score"]) for r in found.collect()}
    exact = [(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows]
    assert got == brute(exact, {i for i, _ in rows if i is not None and i % 50 == 0}, k)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0]), (7, [-1.0])], "vec_id long, embedding array<double>")
    queries = df.where("vec_id % 50 = 0")
    got = sorted(map(tuple, topk.top_k(df, "vec_id", "embedding", queries).collect()))
    assert got == [(0, 1, 50, 131072), (0, 2, 7, -65536), (50, 1, 0, 131072), (50, 2, 7, -131072)]
    none = df.where("1 = 0")
    assert topk.top_k(none, "vec_id", "embedding", none).count() == 0
    assert topk.top_k(df, "vec_id", "embedding", none).count() == 0


def test_slices_add_up():
    draw = np.random.default_rng(2)
    values = draw.integers(-500, 500, (130, 9))
    index = topk.Index(values)
    above = (values - index.low) >> topk.DROPPED_BITS
    for query in draw.integers(-300, 300, (20, 9)):
        sums = index.sums(query)
        total = np.zeros(130, dtype=np.int64)
        for i, s in enumerate(sums):
            total += np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << i
        other = (1 << index.bits) - 1 - above
        want = np.where(query >= 0, above, other) @ np.abs(query)
        assert (total == want).all()


def test_very_large_components():
    ids, values = np.arange(3), np.array([[1 << 40], [1 << 50], [-(1 << 62)]])
    got = list(topk.block_top(ids, values, np.array([9]), np.array([[1 << 20]]), 3))
    top = (1 << 63) - 1
    assert got == [(9, 0, 1 << 60), (9, 1, top), (9, 2, -top - 1)] or got == [
        (9, 1, top),
        (9, 0, 1 << 60),
        (9, 2, -top - 1),
    ]


def test_random_queries_need_few_exact_scores():
    draw = random.Random(1)
    values = np.array([[draw.randint(-120, 120) for _ in range(32)] for _ in range(4096)])
    index = topk.Index(values)
    valid = np.full(index.words, ~np.uint64(0))
    for query in values[:20]:
        rows = index.boundary(query, 5, valid)
        assert 5 <= len(rows) < 400
        assert set(np.argsort(-(values @ query), kind="stable")[:5]) <= set(rows.tolist())
