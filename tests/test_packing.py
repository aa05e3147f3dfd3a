"""Packing small files: bins, what is rewritten, and caps by bytes."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.operators import packing


def naive(sizes, target):
    room, found = [], [0] * len(sizes)
    for place in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((i for i, r in enumerate(room) if r >= sizes[place]), None)
        if at is None:
            at = len(room)
            room.append(target)
        room[at] -= sizes[place]
        found[place] = at
    return found


def test_first_fit():
    source = random.Random(3)
    for _ in range(200):
        sizes = [source.choice([0, 1, 7, 20, 49, source.randrange(1, 50)]) for _ in range(source.randrange(1, 40))]
        assert packing.first_fit(np.array(sizes), 100).tolist() == naive(sizes, 100)
    many = np.random.default_rng(1).integers(1, 50, 20_000)
    held = np.bincount(packing.first_fit(many, 100), weights=many)
    assert held.max() <= 100 and (held <= 50).sum() <= 1 and len(held) <= 1.02 * many.sum() / 100 + 1


@pytest.mark.parametrize("group_files", [5, 1000])
def test_bins_of_partition_values(spark, group_files):
    source = random.Random(7)
    rows = [(f"f{i}", source.randrange(0, 120), source.choice(["a", "a", "a", "b", None])) for i in range(200)]
    files = spark.createDataFrame(rows, "path STRING, length BIGINT, p STRING")
    got = {r.path: r.bin for r in packing.bins(files, ["p"], 100, group_files).collect()}
    groups = 3 if group_files == 1000 else 50
    small = {f for f, n, _ in rows if n < 50}
    assert set(got) <= small and len(small) - len(got) <= groups
    held, values = {}, {}
    for file, length, value in rows:
        if file in got:
            held[got[file]] = held.get(got[file], 0) + length
            values.setdefault(got[file], set()).add(value)
    assert sorted(held) == list(range(len(held))) and max(held.values()) <= 100
    assert all(len(v) == 1 for v in values.values())
    assert min(list(got.values()).count(b) for b in held) >= 2
    assert sum(n <= 50 for n in held.values()) <= groups
    assert packing.bins(files.where("false"), ["p"], 100).count() == 0
    assert packing.bins(files.where("length > 60"), (), 100).count() == 0


def sizes(path):
    return {f: os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("partitions", [[], ["p"]])
def test_only_small_files_are_packed(spark, tmp_path, partitions):
    path, new = str(tmp_path / "a"), str(tmp_path / "b")
    wide = F.sha2(F.col("id").cast("string"), 256)
    rows = spark.range(60_000).select("id", wide.alias("text"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("p"))
    for parts, chosen in ((2, "id < 40000"), (30, "id >= 40000")):
        rows.where(chosen).repartition(parts).write.mode("append").partitionBy(*partitions).parquet(path)
    target = 400_000
    before = sizes(path)
    assert packing.pack_small(spark, path, new, partitions, target)
    after = {f: os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(new) if "_packed" not in d
             for f in names if f.endswith(".parquet")}
    small = [n for n in before.values() if n < target // 2]
    assert len(small) > 2 * len(after) and sum(n <= target // 3 for n in after.values()) <= max(1, 4 * len(partitions))
    assert max(after.values()) < 1.1 * target
    read = packing.read_packed(spark, path, new, target)
    opened = {r.f for r in read.select(F.input_file_name().alias("f")).distinct().collect()}
    assert opened.isdisjoint(r.path for r in spark.read.parquet(f"{new}/_packed").collect())
    assert read.exceptAll(rows.select(*read.columns)).isEmpty() and read.count() == 60_000
    assert not packing.pack_small(spark, path, new, partitions, 10)


def test_one_small_file_of_a_value_stays(spark, tmp_path, monkeypatch):
    path, new = str(tmp_path / "a"), str(tmp_path / "b")
    rows = spark.range(90).selectExpr("id", "CASE WHEN id < 80 THEN 'many' ELSE 'one' END AS p")
    rows.where("p = 'many'").repartition(4).write.partitionBy("p").parquet(path)
    rows.where("p = 'one'").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    assert packing.pack_small(spark, path, new, ["p"], 1 << 20)
    assert len(sizes(new)) == 1 + len(sizes(f"{new}/_packed"))
    for most in (packing.MOST_FILES, 0):
        monkeypatch.setattr(packing, "MOST_FILES", most)
        read = packing.read_packed(spark, path, new, 1 << 20)
        assert sorted(map(tuple, read.collect())) == sorted(map(tuple, rows.collect()))


def test_caps_by_bytes(spark, tmp_path):
    path, new = str(tmp_path / "a"), str(tmp_path / "b")
    rows = spark.range(50_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1)
    rows.write.parquet(path)
    cap = packing.overwrite_by_bytes(rows, new, 500_000, like=path)
    found = sizes(new)
    assert 0 < cap < 50_000 and len(found) > 3 and max(found.values()) < 600_000
    assert sum(n > 400_000 for n in found.values()) >= len(found) - 1
    assert spark.read.parquet(new).count() == 50_000
    again = packing.overwrite_by_bytes(rows, new, 1_000_000)  # by the files that are replaced
    assert 1.8 * cap < again < 2.2 * cap
    rows.where("false").write.parquet(str(tmp_path / "none"))
    assert packing.overwrite_by_bytes(rows, new, 500_000, like=str(tmp_path / "none")) is None
