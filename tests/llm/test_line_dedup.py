"""Repeated lines: against a plain version, over several ranges, and of awkward documents."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import line_dedup, queries

SPACE = " \t\n\x0b\x0c\r"
FOLD = {i: i + 32 for i in range(65, 91)}


def folded(line):
    return line.strip(SPACE).translate(FOLD)


def brute(rows, least=10):
    """(lines, dropped, kept text) of each (key, text); a missing key is the largest."""
    order = lambda k: (k is None, k or 0)
    first = {}
    for key, text in rows:
        for line in (text or "").split("\n"):
            k = folded(line)
            if len(k) >= least and (k not in first or order(key) < order(first[k])):
                first[k] = key
    out = []
    for key, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(folded(x)) < least or first[folded(x)] == key]
        out.append((key, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(df):
    bitmaps = line_dedup.keep_bitmaps(df, "doc_id", "text")
    kept = line_dedup.with_kept_lines(df, "doc_id", "text", bitmaps)
    assert kept.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    return sorted(((r[0], r[1], r[2], r[3]) for r in kept.collect()), key=str)


def corpus(seed, size=300):
    """Common lines, one in every document, lines in other case and white space, and long texts."""
    draw = random.Random(seed)
    pool = [f"Line number {i} of the pool" for i in range(60)] + ["short", "", "ünïcödé ö", "ünïcödé öö"]
    rows = []
    for i in range(size):
        lines = ["The line that every document holds"] if draw.random() < 0.9 else []
        for _ in range(draw.choice([0, 1, 3, 12])):
            line = draw.choice(pool) if draw.random() < 0.6 else f"Own line {i} {draw.random()}"
            lines.append(draw.choice(["", " ", "\t\r"]) + draw.choice([line, line.upper()]) + draw.choice(["", "\x0b "]))
        draw.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows.append((size, "\n".join(f"Line number {i % 60} of the pool" for i in range(5000))))
    return rows


@pytest.mark.parametrize("ranges", [1, 8, 97])
def test_against_brute_force(spark, ranges):
    """With as many ranges as a hot line spreads over many of them."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = corpus(ranges)
        random.Random(1).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert found(df) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_batches_of_few_rows(spark):
    """A range that reaches a task in many small batches."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = corpus(5, 60)
        assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_awkward_documents(spark, awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(awkward) == brute(rows)
    assert found(nothing) == []
    more = [(7, "The same line here"), (7, "Another line, then\nthe same line here"), (None, "The same line here"),
            (None, None), (9, "The same line here"), (9, "The same line here"), (8, "")]
    df = spark.createDataFrame(more, "doc_id long, text string")
    df = df.withColumns({"mark": F.lit(1), "keep": F.lit("x"), "n_dropped": F.lit(2), "k": F.lit(3), "line": F.lit(4)})
    assert found(df) == brute(more)
    named = spark.createDataFrame([("b", "A line of some length"), ("a", "a line of some length")], "doc_id string, text string")
    assert found(named) == [("a", 1, 0, "a line of some length"), ("b", 1, 1, "")]


def test_bitmaps(spark):
    """A bit per line up to the last one dropped, compressed: small even for very long texts."""
    line = "a line that repeats in each text\n"
    df = spark.createDataFrame([(1, line), (2, line * 80_000 + "x" * 20)], "doc_id long, text string")
    (r,) = line_dedup.keep_bitmaps(df, "doc_id", "text").collect()
    assert (r["doc_id"], r["n_dropped"]) == (2, 80_000) and len(r["keep"]) < 200
    assert line_dedup.kept_lines((line * 80_000 + "x" * 20).encode(), r["keep"]) == (80_001, b"x" * 20)


def test_first_documents_of_a_range():
    """Rows of the range's first hash wait; of later hashes those after the first document go."""
    import pyarrow as pa

    schema = line_dedup.StructType().add("h1", "long").add("h2", "long").add("k", "long")
    schema = schema.add("mark", "long").add("line", "integer")
    rows = [(1, 1, 5, 0, 0), (1, 1, 6, 0, 1), (1, 2, 6, 0, 2), (1, 2, 6, 0, 3), (1, 2, 9, 0, 4), (2, 2, None, 0, 5)]
    types = [pa.int64()] * 4 + [pa.int32()]
    for size in (1, 2, 6):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*p, strict=True), types, strict=True)], names=schema.fieldNames())
            for p in parts
        ]
        out = [tuple(r.values()) for b in line_dedup._first_documents(schema)(iter(batches)) for r in b.to_pylist()]
        assert out == [(1, 1, 5, 0, 0), (1, 1, 6, 0, 1), (None, None, 9, 0, 4), (2, 2, None, None, None)]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_line_dedup"](spark, folder).collect()}
    assert got == {
        k: (n, d, hashlib.sha256(t.encode()).hexdigest()) for k, n, d, t in brute(rows)
    }
    assert np.sum([d for _, d, _ in got.values()]) > 0
