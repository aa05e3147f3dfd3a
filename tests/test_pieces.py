"""Queries that make files first: as many tasks as the rows need, none with the whole table."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from tidegate.operators import routing, tables
from tidegate.plans import q_streams, q_tables
from tidegate.sources import inventory

LINES = (
    "id div 4 AS l_orderkey",
    "CAST(id % 4 AS INT) AS l_linenumber",
    "elt(1 + pmod(hash(id), 4), 'N', 'N', 'A', 'R') AS l_returnflag",
    "CAST(pmod(hash(id, 1), 50) AS DOUBLE) AS l_quantity",
    "md5(CAST(id AS STRING)) AS l_comment",
)


def made_folders(monkeypatch, module):
    """Folders that a query takes, by their labels."""
    found, before = {}, module.work_folder
    monkeypatch.setattr(module, "work_folder", lambda s, label: found.setdefault(label, before(s, label)))
    return found


@pytest.mark.parametrize("name", ["compacted_small_only", "packed_small_files", "compacted_partitions"])
def test_no_task_holds_the_table(spark, tmp_path, monkeypatch, name):
    spark.range(100_000).selectExpr(*LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(q_tables, "FILE_ROWS", 5_000, raising=False)
    folders = made_folders(monkeypatch, q_tables)
    rows = getattr(q_tables, name)(spark, str(tmp_path))
    path = folders["scattered" if name == "compacted_partitions" else "mixed"]
    most = spark.read.parquet(path).groupBy(F.col(inventory.FILE_PATH)).count().agg(F.max("count")).first()[0]
    assert most <= 4_000
    if name == "compacted_partitions":
        assert rows.agg(F.sum("rows")).first()[0] == 100_000
    else:
        flags = rows.select(*rows.columns[5:]).distinct().collect()
        assert len(flags) == 1 and all(flags[0])
        lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
        assert rows.select(*lines.columns).exceptAll(lines).isEmpty() and rows.count() == 100_000


def test_compacted_values_do_not_share_tasks(spark, tmp_path):
    path, new = f"{tmp_path}/old", f"{tmp_path}/new"
    rows = spark.range(60_000).selectExpr("id", "md5(CAST(id AS STRING)) AS text", "id % 7 AS value")
    rows.repartition(8).write.partitionBy("value").parquet(path)
    assert tables.compact(spark, path, new, ["value"], target_bytes=200_000)
    files = glob.glob(f"{new}/value=*/*.parquet")
    tasks = [re.search(r"part-(\d+)-", f)[1] for f in files]
    assert len(files) > 7 and len(set(tasks)) == len(files)
    assert spark.read.parquet(new).exceptAll(rows).isEmpty() and spark.read.parquet(new).count() == 60_000


def test_announcements_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    columns = (
        "id AS doc_id", "concat('text ', id) AS text", "'en' AS lang",
        "concat('src', id % 3) AS source", "CAST(10 + id % 5 AS INT) AS n_chars",
    )
    spark.range(600).selectExpr(*columns).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(q_streams, "ANNOUNCED_ROWS", 100, raising=False)
    folders = made_folders(monkeypatch, q_streams)
    found = q_streams.stream_announced_once(spark, str(tmp_path))
    assert found.count() == 600 and found.where("times <> 1").isEmpty()
    # three batches with rows, and one that only moves the watermark
    assert len(glob.glob(f"{folders['decided']}/batch_id=*")) in (3, 4)
    announced = spark.read.json(folders["announced"]).groupBy(F.col(inventory.FILE_PATH)).count()
    assert announced.agg(F.max("count")).first()[0] <= 110 and announced.count() == 18


def test_routing_aggregates_lengths_alone(spark):
    """A mapping in the buffer of an aggregate would have every hit sorted."""
    files = spark.createDataFrame([("s3://in/a/b/1",), ("s3://in/c/1",), (None,)], "file_path string")
    mappings = spark.createDataFrame(
        [("a/", "A", 0), ("a/b/", "B", 1), ("a/b/", "late", 2)], "s3_prefix string, target_name string, position int"
    )
    routed = routing.route_by_table(files, mappings)
    assert "max_by" not in routed._jdf.queryExecution().toString()
    got = {r.file_path: r.target_name for r in routed.select("file_path", "mapping.target_name").collect()}
    assert got == {"s3://in/a/b/1": "B", "s3://in/c/1": None, None: None}
