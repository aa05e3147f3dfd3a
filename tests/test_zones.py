"""Scans by zones: the same rows as a full scan, from few files."""

import pytest
from pyspark.sql import functions as F

from tidegate.operators import zones


@pytest.fixture
def zoned(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(4000).select(
        "id", (F.col("id") * 7919 % 4001).alias("v"), F.when(F.col("id") % 50 > 0, F.col("id") % 13).alias("w")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    zones.write_zoned(rows, path, ["v", "w"])
    yield path, rows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def same(df, want):
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("low, high", [(100, 300), (None, 20), (3990, None), (None, None), (9000, None), (700, 700)])
def test_rows_equal_a_full_scan(spark, zoned, low, high):
    path, rows = zoned
    low_c, high_c = (None if x is None else F.lit(x) for x in (low, high))
    want = rows.where(F.col("v").between(-1 if low is None else low, 10**6 if high is None else high))
    found = zones.scan(spark, path, "v", low_c, high_c)
    assert found.columns == rows.columns
    same(found, want)
    total = len(spark.read.parquet(path).inputFiles())
    assert total == 8
    if low is not None or high is not None:
        assert len(found.inputFiles()) <= 2 or low == 9000


def test_bytes_fall_with_the_range(spark, zoned):
    path, _ = zoned
    size = lambda *ends: zones.needed_files(spark, path, "v", *map(F.lit, ends)).where("needed").agg(F.sum("size")).first()[0] or 0
    assert 0 == size(5000, 6000) < size(0, 10) < size(0, 1200) < size(0, 2600) < size(0, 4000)


def test_a_column_without_zones_and_nulls(spark, zoned):
    path, rows = zoned
    same(zones.scan(spark, path, "id", F.lit(10), F.lit(30)), rows.where("id between 10 and 30"))
    same(zones.scan(spark, path, "w", F.lit(3), F.lit(4)), rows.where("w between 3 and 4"))


def test_files_added_later(spark, zoned):
    """Files without zones are read; their zones are added without reading the others."""
    path, rows = zoned
    more = rows.select((F.col("id") + 10_000).alias("id"), (F.col("v") + 10_000).alias("v"), "w")
    more.write.mode("append").parquet(path)
    both = rows.union(more)
    same(zones.scan(spark, path, "v", F.lit(3900), F.lit(10_050)), both.where("v between 3900 and 10050"))
    before = zones.read_zones(spark, path).count()
    zones.add_zones(spark, path, ["v", "w"])
    after = zones.read_zones(spark, path)
    assert after.count() == before + 8 == after.select("file").distinct().count()
    same(zones.scan(spark, path, "v", F.lit(3900), F.lit(10_050)), both.where("v between 3900 and 10050"))


def test_partitioned_tables_and_no_rows(spark, tmp_path):
    path = str(tmp_path / "parts")
    rows = spark.range(300).select("id", (F.col("id") % 7).alias("v"), (F.col("id") % 3).alias("p"))
    zones.write_zoned(rows, path, ["v"], partition_by=("p",))
    found = zones.scan(spark, path, "v", F.lit(2), F.lit(3))
    assert found.columns == ["id", "v", "p"]
    same(found, rows.where("v between 2 and 3").select("id", "v", F.col("p").cast("int")))
    empty = str(tmp_path / "none")
    zones.write_zoned(rows.where("1 = 0"), empty, ["v"])
    assert zones.scan(spark, empty, "v", F.lit(0)).count() == 0
