import os
import random

import pytest
from pyspark.sql import functions as F

from tidegate.functions.partitioning import PartitionField, SortField
from tidegate.operators import statistics, tables


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


SCHEMA = "k INT, v INT, s STRING"


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("conditional", [True, False])
def test_merge_is_the_loop(spark, broadcast, conditional):
    rng = random.Random(3)
    target = [(rng.choice([None, 7, 7, 7, rng.randrange(50)]), rng.randrange(100), "t") for _ in range(300)]
    keys = [*rng.sample(range(80), 40), None, None]
    source = [(k, rng.randrange(100), "s") for k in keys]
    by_key = {k: (k, v, s) for k, v, s in source if k is not None}
    want = []
    for row in target:
        new = by_key.get(row[0])
        want.append(new if new and (not conditional or new[1] > row[1]) else row)
    present = {row[0] for row in target}
    want += [r for r in source if r[0] is None or r[0] not in present]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if broadcast else "-1")
    try:
        merged = tables.merge(
            spark.createDataFrame(target, SCHEMA),
            spark.createDataFrame(source, SCHEMA).select("s", "v", "k"),
            ["k"],
            F.col("source.v") > F.col("target.v") if conditional else None,
        )
        got = [tuple(r) for r in merged.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_merge_condition_that_is_null_keeps_the_row(spark):
    target = spark.createDataFrame([(1, None, "t")], SCHEMA)
    source = spark.createDataFrame([(1, 5, "s")], SCHEMA)
    merged = tables.merge(target, source, ["k"], F.col("source.v") > F.col("target.v"))
    assert [tuple(r) for r in merged.collect()] == [(1, None, "t")]


def test_merge_refuses_repeated_source_keys_and_missing_columns(spark):
    target = spark.createDataFrame([(1, 1, "t")], SCHEMA)
    with pytest.raises(ValueError, match="more than one row"):
        tables.merge(target, spark.createDataFrame([(2, 1, "s"), (2, 2, "s")], SCHEMA), ["k"])
    with pytest.raises(ValueError, match="lacks columns: s"):
        tables.merge(target, spark.createDataFrame([(2, 1)], "k INT, v INT"), ["k"])


def test_merge_on_two_keys(spark):
    target = spark.createDataFrame([(1, 1, "t"), (1, 2, "t")], SCHEMA)
    source = spark.createDataFrame([(1, 2, "s"), (2, 1, "s")], SCHEMA)
    got = sorted(tuple(r) for r in tables.merge(target, source, ["k", "v"]).collect())
    assert got == [(1, 1, "t"), (1, 2, "s"), (2, 1, "s")]


def test_as_of_and_snapshots(spark):
    log = spark.createDataFrame(
        [("a", 1, 10, "x"), ("a", 2, 20, "y"), ("b", 1, 10, "z"), ("a", 3, 30, "w")],
        "k STRING, version INT, committed_at INT, v STRING",
    )
    at = {t: sorted(r.v for r in tables.as_of(log, ["k"], F.lit(t)).collect()) for t in (5, 10, 25, 99)}
    assert at == {5: [], 10: ["x", "z"], 25: ["y", "z"], 99: ["w", "z"]}
    assert [tuple(r) for r in tables.snapshots(log).orderBy("version").collect()] == [(1, 10, 2), (2, 20, 1), (3, 30, 1)]


def test_append_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([(1,)], "a INT"), path)
    tables.append(spark.createDataFrame([(2, "x")], "a INT, b STRING"), path)
    assert sorted(tuple(r) for r in tables.read_merged(spark, path).collect()) == [(1, None), (2, "x")]


def test_create_table_once_sorted_and_partitioned(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "timestamp_seconds(id * 86400) AS at", "id % 7 AS v")
    spec = [PartitionField("at", "month", "month")]
    sort = [SortField("v", "desc"), SortField("id")]
    path = str(tmp_path / "t")
    assert tables.create_table(df, "made_once", path, spec, sort)
    assert not tables.create_table(df, "made_once", path, spec, sort)
    assert spark.table("made_once").count() == 100
    rows = spark.read.parquet(f"{path}/month=1970-02").collect()
    order = [(-r.v, r.id) for r in rows]
    assert len(rows) == 28 and order == sorted(order)
    tables.add_columns(spark, "made_once", [("note", "STRING", "it's new")])
    fields = {f.name: f for f in spark.table("made_once").schema}
    assert fields["note"].metadata["comment"] == "it's new"
    assert spark.table("made_once").filter("note IS NOT NULL").count() == 0


def test_with_added_columns_and_ddl(spark):
    df = tables.with_added_columns(spark.range(1), [("id", "INT"), ("x", "DECIMAL(10,2)")])
    assert df.dtypes == [("id", "bigint"), ("x", "decimal(10,2)")]
    assert tables.ddl(df.schema) == "id BIGINT NOT NULL,x DECIMAL(10,2)"


def test_compaction_without_partitions_does_not_shuffle(spark, tmp_path):
    path, new = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(0, 10_000, 1, 20).write.parquet(path)
    assert tables.compact(spark, path, new)
    assert len(files(new)) == 1
    assert spark.read.parquet(new).agg(F.sum("id")).first()[0] == sum(range(10_000))
    assert not tables.compact(spark, new, str(tmp_path / "c"))


def test_compaction_splits_a_large_partition(spark, tmp_path):
    path, new = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.range(0, 60_000, 1, 12).selectExpr(
        "id", "sha2(cast(id AS STRING), 256) AS t", "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 = 1 THEN 'a b/+%' ELSE 'hot' END AS p"
    )
    df.write.partitionBy("p").parquet(path)
    size = sum(os.path.getsize(f) for f in files(f"{path}/p=hot"))
    assert tables.compact(spark, path, new, ["p"], target_bytes=size // 4)
    counts = {r.p: r["count"] for r in spark.read.parquet(new).groupBy("p").count().collect()}
    assert counts == {None: 6_000, "a b/+%": 6_000, "hot": 48_000}
    assert spark.read.parquet(new).select("id").distinct().count() == 60_000
    hot = [f for f in files(new) if "p=hot" in f]
    assert 3 <= len(hot) <= 5
    assert max(os.path.getsize(f) for f in hot) < size // 2


def test_load_counts_and_paths(spark, tmp_path):
    df = spark.range(10).withColumn("reject_reason", F.when(F.col("id") > 6, "large"))
    result = tables.load(df, "T", str(tmp_path / "l"))
    assert (result.target_name, result.loaded_records, result.rejected_records) == ("T", 7, 3)
    assert spark.read.parquet(result.loaded_path).count() == 7
    assert {r.reject_reason for r in spark.read.parquet(result.rejected_path).collect()} == {"large"}
    again = tables.load(df, "T", str(tmp_path / "l"), "x")
    assert again.load_id == "x" and again.load_duration_ms > 0
    tables.load(df, "T", str(tmp_path / "l"), "x")
    assert spark.read.parquet(str(tmp_path / "l")).count() == 20
    row = spark.range(1).select(again.struct().alias("r")).first().r
    assert (row.load_id, row.loaded_records, row.rejected_records) == ("x", 7, 3)
    none = tables.load(df.filter("id < 0"), "T", str(tmp_path / "n"), "y")
    assert (none.loaded_records, none.rejected_records) == (0, 0)


def test_current_rows_takes_the_newest_change(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    changes = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k INT, v STRING, n INT")
    got = sorted(tuple(r) for r in tables.current_rows(base, changes, ["k"], "n").collect())
    assert got == [(1, "a"), (2, "y"), (3, "z")]


def test_top_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS g", "id AS v")
    best = statistics.top_per_group(df, ["g"], 3, "v")
    assert sorted((r.g, r.rn, r.v) for r in best.collect()) == [
        (0, 1, 998), (0, 2, 996), (0, 3, 994), (1, 1, 999), (1, 2, 997), (1, 3, 995),
    ]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_is_taken_per_task(spark):
    plan = statistics.top(spark.range(1000), 5, "id")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_file_ranges_prune(spark):
    ranges = spark.createDataFrame([("f1", 1, 5), ("f2", 6, 9), ("f3", None, None)], "file STRING, min_v INT, max_v INT")
    test = statistics.may_contain("v", low=F.lit(5), high=F.lit(6))
    row = statistics.scan_efficiency(ranges, F.lit("t"), test).first()
    assert (row.files_scanned, row.files_total) == (2, 3)
    assert [r.file for r in ranges.filter(statistics.may_contain("v", low=F.lit(6))).collect()] == ["f2"]


@pytest.mark.parametrize("partitions", [[], ["p"]])
def test_only_small_files_are_rewritten(spark, tmp_path, partitions):
    path, new = str(tmp_path / "a"), str(tmp_path / "b")

    def put(low, high, files):
        rows = spark.range(low, high, 1, files).selectExpr("id", "sha2(cast(id AS STRING), 256) AS t", "id % 2 AS p")
        rows.coalesce(files).write.mode("append").partitionBy(*partitions).parquet(path)

    put(0, 20_000, 1)
    large = {f: os.path.getmtime(f) for f in files(path)}
    limit = min(os.path.getsize(f) for f in large)
    put(20_000, 20_400, 8)
    assert tables.compact_small(spark, path, new, partitions, target_bytes=limit)
    read = tables.read_compacted(spark, path, new, limit)
    assert sorted(r.id for r in read.select("id").collect()) == list(range(20_400))
    assert len(files(new)) == max(1, 2 * len(partitions))
    assert spark.read.parquet(new).count() == 400
    assert {f: os.path.getmtime(f) for f in large} == large
    assert not tables.compact_small(spark, new, str(tmp_path / "c"), partitions, target_bytes=1)


def test_compaction_heeds_a_larger_target(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(0, 1000, 1, 4).write.parquet(path)
    size = max(os.path.getsize(f) for f in files(path))
    assert not tables.compact(spark, path, str(tmp_path / "b"), target_bytes=size // 100)
    assert tables.compact(spark, path, str(tmp_path / "c"), target_bytes=size * 100)
    assert len(files(str(tmp_path / "c"))) == 1
